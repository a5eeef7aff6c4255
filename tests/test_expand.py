import itertools

import pytest
from pyspark.sql import functions as F

from cubestar.operators.expand import (
    dimension_members,
    expand_requests,
    member_counts,
    plan_periods,
    unnest_requests,
)
from cubestar.operators.units import enrich_units
from cubestar.schema import DIMENSION_COLUMNS
from helpers import cube, metadata, observations, values

SLOT_COLUMNS = [c for c in DIMENSION_COLUMNS if c[0] == "d" and c[1] in "456789"]


def variable(id, nome="var", unidade="BRL"):
    return {"id": str(id), "nome": nome, "unidade": unidade}


def category(id, unidade=None):
    return {"id": str(id), "nome": f"cat {id}", "unidade": unidade}


def test_variables_alone(spark):
    df = dimension_members(metadata(spark, cube(variables=[variable(1, "GDP"), variable(2, "POP")])))
    assert sorted(values(df, "d2c", "mc", "mn")) == [("1", None, "BRL"), ("2", None, "BRL")]
    assert all(v is None for r in values(df, *SLOT_COLUMNS) for v in r)


def test_one_classification(spark):
    df = dimension_members(metadata(spark, cube(classes=[(1, [10, 20])])))
    assert sorted(values(df, "d4c", "d4n", "d5c")) == [("10", "cat 10", None), ("20", "cat 20", None)]


def test_product_and_six_slots(spark):
    two = dimension_members(metadata(spark, cube(classes=[(1, [1, 2]), (2, [10, 20])])))
    assert sorted(values(two, "d4c", "d5c")) == sorted(itertools.product("12", ("10", "20")))
    six = dimension_members(metadata(spark, cube(classes=[(i, [i]) for i in range(6)])))
    assert values(six, "d4c", "d5c", "d6c", "d7c", "d8c", "d9c") == [tuple("012345")]


def test_empty_classification_and_seventh(spark):
    assert dimension_members(metadata(spark, cube(classes=[(1, [1]), (2, [])]))).count() == 0
    described = metadata(spark, cube("77", classes=[(i, [i]) for i in range(6)] + [(6, [1, 2])]))
    with pytest.raises(Exception, match="cube 77 has more than 6"):
        dimension_members(described).collect()
    seven = dimension_members(described, drop_classifications=True)
    assert seven.count() == 2 and seven.distinct().count() == 1


def test_unit_precedence(spark):
    classes = [(1, [category(1, "USD"), category(2)]), (2, [category(8, "EUR"), category(9)])]
    df = dimension_members(metadata(spark, cube(classes=classes)))
    got = {(a, b): u for a, b, u in values(df, "d4c", "d5c", "mn")}
    assert got == {("1", "8"): "USD", ("1", "9"): "USD", ("2", "8"): "EUR", ("2", "9"): "BRL"}


def carried(classes, unit):
    """Brute force: the unit of a combination stays until another one comes."""
    out, current = {}, unit
    for combo in itertools.product(*classes):
        own = [k["unidade"] for k in combo if k["unidade"] is not None]
        current = own[0] if own else current
        out[tuple(k["id"] for k in combo)] = current
    return out


@pytest.mark.parametrize("block_size", [1, 3, 7, 1000])
def test_carried_units(spark, block_size):
    classes = [
        [category(i, "A" if i == 3 else None) for i in range(1, 6)],
        [category(i, "B" if i == 13 else None) for i in range(11, 15)],
        [category(i, "C" if i == 22 else None) for i in range(21, 24)],
    ]
    df = dimension_members(
        metadata(spark, cube(classes=list(enumerate(classes)))),
        carry_units=True, block_size=block_size,
    )
    got = {(a, b, c): u for a, b, c, u in values(df, "d4c", "d5c", "d6c", "mn")}
    assert got == carried(classes, "BRL")


@pytest.mark.parametrize("block_size", [1, 4, 1000])
def test_blocks_cover_the_product_once(spark, block_size):
    described = metadata(
        spark,
        cube("1", classes=[(1, range(3)), (2, range(5))], variables=[variable(1), variable(2)]),
        cube("2", classes=[(1, range(4))]),
        cube("3"),
    )
    df = dimension_members(described, block_size=block_size)
    assert df.count() == df.distinct().count() == 2 * 15 + 4 + 1
    assert dict(values(member_counts(described), "tabela_sidra_id", "n_members")) == {"1": 30, "2": 4, "3": 1}


def test_size_guard(spark):
    described = metadata(spark, cube(classes=[(1, range(10)), (2, range(10))]))
    with pytest.raises(ValueError, match="100 members"):
        dimension_members(described, max_rows=99)


def combos(spark, classes):
    described = metadata(spark, cube(classes=classes)).select("id", "classificacoes")
    return [r[0] for r in unnest_requests(described, ["id"]).select("combination").collect()]


def entries(df):
    """Map entries in stored order; a Python dict need not keep it."""
    rows = df.select(F.map_entries("classifications")).collect()
    return [[(e.key, e.value) for e in r[0]] for r in rows]


def by_text(maps):
    return sorted(maps, key=str)


def test_unnested_requests(spark):
    assert by_text(combos(spark, [(1, [10, 20]), (2, [100])])) == [
        {"1": ["10"], "2": ["100"]}, {"1": ["20"], "2": ["100"]},
    ]
    assert combos(spark, [(1, [0, 5])]) == [{"1": ["5"]}]
    assert combos(spark, []) == []
    eight = combos(spark, [(1, [10, 11]), (2, [20, 21]), (3, [30, 31])])
    assert len({str(c) for c in eight}) == 8


def requests(spark, **fields):
    base = {
        "request_id": "'r1'", "tabela_sidra": "'1'",
        "territories": "map('6', CAST(array() AS ARRAY<STRING>))",
        "variables": "CAST(NULL AS ARRAY<STRING>)",
        "classifications": "CAST(NULL AS MAP<STRING, ARRAY<STRING>>)",
        "unnest": "CAST(NULL AS STRING)", "unnest_ids": "CAST(array() AS ARRAY<STRING>)",
        "split_variables": "false",
    }
    base.update(fields)
    return spark.sql("SELECT " + ", ".join(f"{v} AS {k}" for k, v in base.items()))


def test_partial_unnest_merges_static(spark):
    described = metadata(spark, cube(classes=[(87, [10, 20]), (99, [5])]))
    asked = requests(
        spark, classifications="map('81', array('allxt'))", unnest="'listed'",
        unnest_ids="array('87')",
    )
    got = [r.classifications for r in expand_requests(asked, described).collect()]
    assert by_text(got) == by_text(
        [{"81": ["allxt"], "99": ["all"], "87": [c]} for c in ("10", "20")]
    )


def test_combination_overrides_static(spark):
    described = metadata(spark, cube(classes=[(87, [10]), (99, [5])]))
    asked = requests(
        spark, classifications="map('87', array('x'), '99', array('y'))", unnest="'listed'",
        unnest_ids="array('87')",
    )
    merged = expand_requests(asked, described)
    assert entries(merged) == [[("87", ["10"]), ("99", ["y"])]]


def test_full_unnest_drops_static(spark):
    described = metadata(spark, cube(classes=[(1, [0, 7])]))
    asked = requests(spark, classifications="map('9', array('x'))", unnest="'all'")
    assert [r.classifications for r in expand_requests(asked, described).collect()] == [{"1": ["7"]}]
    assert expand_requests(asked, metadata(spark, cube())).count() == 0


def test_split_variables(spark):
    described = metadata(spark, cube(classes=[(1, [7, 8])]))
    split = requests(spark, variables="array('1', '2')", split_variables="true")
    assert sorted(r.variables for r in expand_requests(split, described).collect()) == [["1"], ["2"]]
    both = requests(spark, variables="array('1', '2')", split_variables="true", unnest="'all'")
    assert [r.variables for r in expand_requests(both, described).collect()] == [["1", "2"]] * 2
    assert expand_requests(both, described, combine=True).count() == 4


def test_period_plan_defaults(spark):
    described = metadata(spark, cube(classes=[(81, [1]), (87, [2])]))
    plan = plan_periods(requests(spark).drop("unnest", "unnest_ids", "split_variables"), described)
    rows = plan.orderBy(F.col("periods")[0]).collect()
    assert [r.periods for r in rows] == [["202001"], ["202002"]]
    assert rows[0].variables == ["all"]
    assert entries(plan)[0] == [("81", []), ("87", [])]
    assert str(rows[0].modificacao) == "2024-01-01" and rows[0].format == "A"


def test_unit_codes_from_data(spark):
    described = metadata(
        spark,
        cube(classes=[(1, [category(7), category(8), category(9, "Kilo")])], variables=[variable(5, unidade="Units")]),
    )
    seen = observations(
        spark,
        {"D4C": "7", "MC": " 10 ", "MN": " Units "},
        {"D4C": "7", "MC": None},
        {"D2C": "6", "D4C": None, "MC": "99", "MN": "Other", "V": None},
    )
    got = {d4c: mc for d4c, mc in values(enrich_units(dimension_members(described), seen), "d4c", "mc")}
    assert got == {"7": "10", "8": "10", "9": None}


def test_last_observed_unit_wins(spark):
    described = metadata(spark, cube(variables=[variable(5, unidade="Other")]))
    rows = [
        {"D4C": None, "MC": "old", "file_path": "a", "pos": 9},
        {"D4C": None, "MC": "new", "file_path": "b", "pos": 1},
        {"D4C": None, "MC": "older", "file_path": "a", "pos": 3},
    ]
    seen = observations(spark, *rows, extra=("file_path", "pos"))
    assert values(enrich_units(dimension_members(described), seen), "mc") == [("new",)]
