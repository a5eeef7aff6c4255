import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cubestar.functions.codes import (
    clean_code,
    coerce,
    content_key,
    null_sentinels,
    normalize_level,
    numeric_value,
    period_key,
    strip,
    value_flag,
)
from helpers import values


def column(spark, items, kind="string"):
    return spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}").orderBy("i")


def applied(spark, items, f, kind="string"):
    return [r[0] for r in column(spark, items, kind).select("i", F.expr(f("x")).alias("y")).orderBy("i").select("y").collect()]


def test_coerce(spark):
    assert applied(spark, [None, "hello"], coerce) == [None, "hello"]
    assert applied(spark, [42, 0, None], coerce, "int") == ["42", "0", None]


def test_clean_code(spark):
    given_ = [None, "1100015.0", "  abc  ", "ABC", "0", "\t7.0\n", "1.0.0", ".0", " 8 ", "\x1c9", "a.01"]
    assert applied(spark, given_, clean_code) == ["", "1100015", "abc", "ABC", "0", "7", "1.0", "", "8", "9", "a.01"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="a0. \t\n\r\x0b\x0c\x1c\x1f\x85   ​　é", max_size=8), min_size=1, max_size=40))
def test_strip_matches_text_strip(spark, items):
    assert applied(spark, items, strip) == [x.strip() for x in items]


def test_normalize_level(spark):
    assert applied(spark, ["6", "N6", "", "101"], normalize_level) == ["N6", "N6", "", "N101"]


def test_sentinels(spark):
    df = spark.createDataFrame([("...", "-", "X"), ("..", "C", "1")], "V string, NC string, MN string")
    assert values(null_sentinels(df), "V", "NC", "MN") == [(None, None, "X"), ("..", "C", "1")]


def test_numeric_guard(spark):
    given_ = ["12.57", "-3", "X", "..", ".5", "+5", "12abc", "1e3", None]
    result = applied(spark, given_, lambda c: f"CAST({numeric_value(c)} AS DOUBLE)")
    assert result == [12.57, -3.0, None, None, None, None, None, 1000.0, None]


def test_numeric_guard_strict_fails(spark):
    import pytest

    with pytest.raises(Exception, match="12abc"):
        applied(spark, ["12abc"], lambda c: numeric_value(c, strict=True))


def test_value_flags(spark):
    given_ = ["1", "-2", "X", "C", "..", "...", "-", "?"]
    assert applied(spark, given_, value_flag) == ["number", "number", "X", "C", "..", "...", "-", "other"]


def test_content_key(spark):
    rows = [(None, "ab"), ("", "ab"), ("a", "b"), ("ab", ""), ("ab", None)]
    df = spark.createDataFrame(rows, "a string, b string")
    keys = [r[0] for r in df.select(F.expr(content_key("a", "b"))).collect()]
    assert len(set(keys)) == len(rows)
    assert keys[2] == hashlib.md5(b"v1:av1:b").hexdigest()


def test_period_key_tells_null_from_empty_literals(spark):
    df = spark.sql(
        "SELECT '1' AS c, CAST(NULL AS ARRAY<STRING>) AS l UNION ALL"
        " SELECT '1', CAST(array() AS ARRAY<STRING>) UNION ALL SELECT '1', array('a') UNION ALL"
        " SELECT '1', array('a', 'b') UNION ALL SELECT '1', array('a|1:b')"
    )
    assert df.select(F.expr(period_key("c", "l"))).distinct().count() == 5
