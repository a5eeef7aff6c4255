import pytest
from pyspark.sql import functions as F

from cubestar.operators.outputs import annual_summary, flatten, point_lookup, union_outputs
from cubestar.operators.quality import (
    orphan_facts,
    primary_key_violations,
    range_violations,
    star_duplicates,
    star_missing,
    unique_violations,
)
from cubestar.plans.load import load_batch, load_into, load_metadata, save_metadata
from cubestar.plans.materialize import KeyViolation, check_outputs, materialize
from cubestar.plans.presets import SUMMARY_COLUMNS, flat_output, point_series
from cubestar.schema import empty_star
from cubestar.sources.star_tables import create_star, register_star
from helpers import D2, cube, metadata, observations, values

ROWS = [
    {"V": "12.57"},
    {"D1C": "200", "V": "X"},
    {"D3C": "202002", "V": "-3"},
    {"D3C": "202002", "D4C": "8", "D4N": "Other", "V": "4"},
    {"D3C": "202002", "D1C": "200", "V": "..."},
]


@pytest.fixture(scope="module")
def star(spark):
    described = load_metadata(empty_star(spark), metadata(spark, cube("1")))
    return load_batch(described, observations(spark, *ROWS)).star


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("star") / "star")
    create_star(spark, path)
    save_metadata(spark, path, metadata(spark, cube("1")))
    load_into(spark, path, observations(spark, *ROWS))
    register_star(spark, path, "stored_star")
    return "stored_star"


def test_flat_values(star):
    flat = flat_output(star, ["1"]).select("periodo", "localidade_id", "categoria", F.col("valor").cast("double").alias("v"))
    assert sorted(values(flat, "periodo", "localidade_id", "categoria", "v"), key=str) == [
        ("202001", "100", "Cat", 12.57), ("202001", "200", "Cat", None),
        ("202002", "100", "Cat", -3.0), ("202002", "100", "Other", 4.0),
    ]
    assert flat_output(star, ["none"]).count() == 0


def test_inactive_cells_are_left_out(spark, star):
    newer = load_batch(star, observations(spark, {"V": "13", "modificacao": D2})).star
    rows = flat_output(newer, ["1"]).filter("periodo = '202001'")
    assert [float(r.valor) for r in rows.collect()] == [13.0]


def test_point_series_casts_as_documented(star):
    assert [r.ano for r in point_series(star, "1", "100").collect()] == [2020] * 3
    with pytest.raises(Exception, match="X"):
        point_series(star, "1", "200").collect()
    assert values(point_series(star, "1", "200", strict=False), "mes", "valor") == [(1, None)]


def test_lookup_newest_first(star):
    found = point_lookup(flat_output(star, ["1"]), "100")
    assert [r.periodo for r in found.collect()] == ["202002", "202002", "202001"]


def test_annual_summary(star):
    got = {(r.localidade_id, r.categoria): r for r in annual_summary(flatten(star, ["1"], SUMMARY_COLUMNS)).collect()}
    cat = got["100", "Cat"]
    assert (cat.n, float(cat.soma), cat.media, float(cat.minimo), float(cat.maximo)) == (2, 9.57, 4.785, -3.0, 12.57)
    none = got["200", "Cat"]
    assert (none.n, none.soma, none.media) == (0, None, None)


def test_union_is_ordered_by_child_name(spark):
    one = spark.sql("SELECT 1 AS x")
    assert values(union_outputs({"b": one, "a": one}).coalesce(1), "source") == [("a",), ("b",)]


def test_output_guards():
    good = {"name": "n", "schema": "s", "strategy": "view", "sql": "SELECT 1"}
    assert check_outputs([good]) == []
    assert check_outputs([]) and check_outputs({"name": "single"})
    assert "strategy" in check_outputs([{"name": "n", "schema": "s", "sql": "x"}])[0]
    assert "unknown strategy" in check_outputs([{**good, "strategy": "merge"}])[0]
    assert "duplicate" in check_outputs([good, good])[0]


def output(name, sql, strategy="replace", **more):
    return {"name": name, "schema": "out", "strategy": strategy, "sql": sql, **more}


def run(spark, database, tmp_path, *outputs):
    materialize(spark, outputs, database, str(tmp_path))


def test_table_then_view(spark, database, tmp_path):
    run(
        spark, database, tmp_path,
        output("places", "SELECT d1c, d1n FROM localidade;", primary_key=["d1c"],
               indexes=[{"name": "i", "columns": ["d1n"]}, {"name": "u", "columns": ["d1c"], "unique": True}],
               description="All 'places'"),
        output("n_places", "SELECT count(*) AS n FROM out.places", "view"),
    )
    assert values(spark.table("out.n_places"), "n") == [(2,)]
    assert spark.catalog.currentDatabase() == "default"
    run(spark, database, tmp_path, output("places", "SELECT 'x' AS d1c, 'y' AS d1n"))
    assert values(spark.table("out.n_places"), "n") == [(1,)]


def test_percent_signs_are_left_alone(spark, database, tmp_path):
    run(spark, database, tmp_path, output("like", "SELECT d1c FROM localidade WHERE d1c LIKE '1%'"))
    assert values(spark.table("out.like"), "d1c") == [("100",)]


def test_broken_key_keeps_the_old_table_and_stops(spark, database, tmp_path):
    run(spark, database, tmp_path, output("kept", "SELECT 1 AS k"))
    with pytest.raises(KeyViolation):
        run(
            spark, database, tmp_path,
            output("before", "SELECT 1 AS k", primary_key=["k"]),
            output("kept", "SELECT explode(array(1, 1)) AS k", primary_key=["k"]),
            output("after", "SELECT 1 AS k"),
        )
    assert values(spark.table("out.kept"), "k") == [(1,)]
    tables = {t.name for t in spark.catalog.listTables("out")}
    assert "before" in tables and "after" not in tables
    assert not any("__" in t for t in tables)


def test_null_breaks_a_key_but_not_a_unique_index(spark, database, tmp_path):
    sql = "SELECT CAST(NULL AS INT) AS k UNION ALL SELECT NULL UNION ALL SELECT 1"
    unique = [{"name": "u", "columns": ["k"], "unique": True}]
    run(spark, database, tmp_path, output("nulls", sql, indexes=unique))
    with pytest.raises(KeyViolation):
        run(spark, database, tmp_path, output("nulls", sql, primary_key=["k"]))
    with pytest.raises(KeyViolation):
        run(spark, database, tmp_path, output("nulls", sql + " UNION ALL SELECT 1", indexes=unique))


def test_key_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, "c")], "k int, x string")
    assert sorted(values(primary_key_violations(df, ["k", "x"]), "x", "violation", "n_rows")) == [
        ("a", "duplicate", 2), ("b", "null", 2),
    ]
    assert values(unique_violations(df, ["k", "x"]), "k", "n_rows") == [(1, 2)]


def test_ranges(spark):
    df = spark.createDataFrame(
        [("ok", 1, 4, 12), ("null", None, None, None), ("low", 0, 0, 0), ("high", 3, 5, 13)],
        "codigo string, semestre int, trimestre int, mes int",
    )
    got = dict(values(range_violations(df), "codigo", "outside"))
    assert got == {"low": "semestre,trimestre,mes", "high": "semestre,trimestre,mes"}


def test_star_checks(spark, star):
    assert all(df.isEmpty() for df in star_duplicates(star).values())
    assert all(df.isEmpty() for df in star_missing(star).values())
    assert orphan_facts(star).isEmpty()
    broken = star._replace(
        periodo=star.periodo.filter("codigo <> '202001'"),
        dados=star.dados.unionByName(star.dados.withColumn("v", F.lit(None).cast("string"))),
    )
    assert values(orphan_facts(broken), "foreign_key", "n_facts") == [("periodo_id", 4)]
    assert star_duplicates(broken)["dados"].count() == 4
    assert {r.missing for r in star_missing(broken)["dados"].collect()} == {"v"}


def test_old_table_survives_a_failed_rename(spark, monkeypatch):
    """New columns, so that tables are renamed."""
    spark.sql("CREATE DATABASE IF NOT EXISTS publish")
    output = {"name": "t", "schema": "publish", "strategy": "replace", "sql": "SELECT 1 AS x"}
    materialize(spark, [output], "publish")
    run = type(spark).sql

    def failing(self, text, *args, **kwargs):
        if text.startswith("ALTER TABLE `publish`.`t__") and "__old_" not in text:
            raise RuntimeError("no rename")
        return run(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError):
        materialize(spark, [{**output, "sql": "SELECT 2 AS x, 2 AS y"}], "publish")
    monkeypatch.undo()
    assert values(spark.table("publish.t"), "x") == [(1,)]
    assert [t.name for t in spark.catalog.listTables("publish")] == ["t"]
    materialize(spark, [{**output, "sql": "SELECT 3 AS x", "description": "third"}], "publish")
    assert values(spark.table("publish.t"), "x") == [(3,)]
    assert [t.name for t in spark.catalog.listTables("publish")] == ["t"]
    spark.sql("DROP DATABASE publish CASCADE")


def test_every_plain_index_has_an_effect(spark):
    import pyarrow.parquet as pq

    spark.sql("CREATE DATABASE IF NOT EXISTS layout")
    output = {
        "name": "t", "schema": "layout", "strategy": "replace",
        "sql": "SELECT id AS a, id % 7 AS b, CAST(id AS STRING) AS c FROM range(1000)",
        "indexes": [{"name": "i", "columns": ["a"]}, {"name": "j", "columns": ["c"]}],
    }
    materialize(spark, [output], "layout")
    file = spark.table("layout.t").inputFiles()[0].removeprefix("file:")
    text = open(file, "rb").read()
    assert pq.read_table(file).num_rows
    plain = {**output, "indexes": output["indexes"][:1]}
    materialize(spark, [plain], "layout")
    files = spark.table("layout.t").inputFiles()
    assert len(text) > len(open(files[0].removeprefix("file:"), "rb").read())
    spark.sql("DROP DATABASE layout CASCADE")
