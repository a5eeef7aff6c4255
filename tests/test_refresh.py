"""Outputs: the curve through several indexes, the switch of a build, the refresh."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cubestar.plans.clustering import range_ends, z_order
from cubestar.plans.load import load_batch, load_into, save_load, save_metadata
from cubestar.plans.materialize import KeyViolation, materialize
from cubestar.plans.refresh import refresh_output, touched_pairs
from cubestar.sources.star_tables import create_star, read_star, refresh_star, register_star
from helpers import D2, cube, metadata, observations, values

SQL = """SELECT d.tabela_sidra_id AS cubo, d.periodo_id, l.d1c AS place, p.codigo AS periodo, d.v
FROM dados d JOIN localidade l ON d.localidade_id = l.id JOIN periodo p ON d.periodo_id = p.id WHERE d.ativo"""
PARTS = ["cubo", "periodo_id"]


@pytest.fixture
def stored(spark, tmp_path):
    path, database = str(tmp_path / "star"), "refreshed_star"
    create_star(spark, path)
    save_metadata(spark, path, metadata(spark, cube("1"), cube("2")))
    rows = [{"tabela_sidra_id": c, "D1C": str(i), "D3C": p, "V": f"{c}-{i}-{p}"}
            for c in "12" for p in ("202001", "202002") for i in range(5)]
    load_into(spark, path, observations(spark, *rows))
    register_star(spark, path, database)
    yield path, database
    spark.sql(f"DROP DATABASE {database} CASCADE")
    spark.sql("DROP DATABASE IF EXISTS refreshed CASCADE")


def output(**more):
    return {"name": "flat", "schema": "refreshed", "strategy": "replace", "sql": SQL, "partitioned_by": PARTS, **more}


def load(spark, path, database, *rows):
    done = load_batch(read_star(spark, path), observations(spark, *rows))
    save_load(done, path)
    refresh_star(spark, database, path)
    return touched_pairs(done.merged)


def content(spark, table="refreshed.flat"):
    return sorted(map(str, values(spark.table(table), "cubo", "place", "periodo", "v")))


def files(spark):
    rows = spark.table("refreshed.flat").select("cubo", "periodo_id", F.col("_metadata.file_path").alias("f"))
    return {r.f: (r.cubo, r.periodo_id) for r in rows.distinct().collect()}


def test_refresh_equals_a_full_build(spark, stored, tmp_path):
    path, database = stored
    materialize(spark, [output(primary_key=[*PARTS, "place"])], database, str(tmp_path))
    before = files(spark)
    touched = load(
        spark, path, database, {"tabela_sidra_id": "1", "D1C": "0", "V": "revised", "modificacao": D2},
        {"tabela_sidra_id": "1", "D1C": "new", "V": "new", "modificacao": D2},
    )
    assert refresh_output(spark, output(primary_key=[*PARTS, "place"]), database, touched) == 1
    got, after = content(spark), files(spark)
    # Three of four parts keep their files.
    kept = {f: p for f, p in before.items() if p not in {tuple(r) for r in touched.collect()}}
    assert kept and all(after[f] == p for f, p in kept.items()) and len(set(after.values())) == 4
    assert refresh_output(spark, output(), database, touched) == 1 and content(spark) == got
    full = {**output(), "name": "full"}
    materialize(spark, [full], database, str(tmp_path))
    assert content(spark, "refreshed.full") == got
    assert any("revised" in r for r in got) and len(got) == 5 * 3 + 2


def test_parts_that_became_empty_go(spark, stored, tmp_path):
    path, database = stored
    only = output(sql=SQL + " AND d.v NOT LIKE 'hidden%'")
    materialize(spark, [only], database, str(tmp_path))
    touched = load(
        spark, path, database, *[
            {"tabela_sidra_id": "2", "D1C": str(i), "V": "hidden", "modificacao": D2} for i in range(5)
        ],
    )
    assert refresh_output(spark, only, database, touched) == 1
    assert spark.table("refreshed.flat").where("cubo = '2'").select("periodo").distinct().count() == 1
    spark.sql("ALTER TABLE refreshed.flat RECOVER PARTITIONS")
    assert spark.table("refreshed.flat").count() == 15


def test_cubes_an_output_does_not_read(spark, stored, tmp_path):
    path, database = stored
    mine = output(sql=SQL + " AND d.tabela_sidra_id = '1'", cubes=["1"])
    materialize(spark, [mine], database, str(tmp_path))
    before = files(spark)
    touched = load(spark, path, database, {"tabela_sidra_id": "2", "V": "x", "modificacao": D2})
    assert refresh_output(spark, mine, database, touched) == 0 and files(spark) == before


@pytest.mark.parametrize("row, broken", [
    ({"D1C": "9"}, False), ({"D1C": "3"}, True), ({"D1C": "3", "D3C": "202001", "tabela_sidra_id": "1"}, False),
])
def test_keys_of_the_changed_part(spark, stored, tmp_path, row, broken):
    """A key without the partition columns is checked against the other parts too."""
    path, database = stored
    one = "SELECT * FROM (" + SQL + ") WHERE cubo = '1' AND periodo = '202001' OR periodo = '202002' AND cubo = '2' AND place = '9'"
    unique = output(sql=one, indexes=[{"name": "u", "columns": ["place"], "unique": True}])
    materialize(spark, [unique], database, str(tmp_path))
    changed = {"tabela_sidra_id": "2", "D3C": "202002", "V": "n", "modificacao": D2, **row}
    wide = {**unique, "sql": one.replace("place = '9'", f"place = '{changed['D1C']}'")}
    touched = load(spark, path, database, changed)
    before = content(spark)
    if broken:
        with pytest.raises(KeyViolation):
            refresh_output(spark, wide, database, touched)
        assert content(spark) == before
    else:
        refresh_output(spark, wide, database, touched)
        assert any("'n'" in r for r in content(spark))


def test_duplicates_inside_the_changed_part(spark, stored, tmp_path):
    path, database = stored
    materialize(spark, [output()], database, str(tmp_path))
    touched = load(spark, path, database, {"tabela_sidra_id": "1", "V": "x", "modificacao": D2}, {"tabela_sidra_id": "1", "D4C": "8", "V": "x", "modificacao": D2})
    with pytest.raises(KeyViolation):
        refresh_output(spark, output(primary_key=[*PARTS, "place"]), database, touched)


def test_a_build_takes_its_place_in_one_step(spark, tmp_path, monkeypatch):
    """The table is there at every statement of the catalog, old or new."""
    spark.sql("CREATE DATABASE IF NOT EXISTS switched")
    build = {"name": "t", "schema": "switched", "strategy": "replace", "sql": "SELECT 1 AS x"}
    materialize(spark, [build], "switched")
    reader, seen, run = spark.table("switched.t"), [], type(spark).sql

    def watched(self, text, *args, **kwargs):
        out = run(self, text, *args, **kwargs)
        if text.startswith(("ALTER", "DROP", "COMMENT")):
            seen.append((text.split()[0], values(self.table("switched.t"), "x")))
        return out

    monkeypatch.setattr(type(spark), "sql", watched)
    materialize(spark, [{**build, "sql": "SELECT 2 AS x", "description": "second"}], "switched")
    monkeypatch.undo()
    states = [state for _, state in seen]
    switch = [kind for kind, _ in seen].index("ALTER")
    assert states[:switch] == [[(1,)]] * switch and states[switch:] == [[(2,)]] * (len(seen) - switch)
    assert values(reader, "x") == [(1,)]  # its files are kept
    materialize(spark, [{**build, "sql": "SELECT 3 AS x, 4 AS y"}], "switched")
    assert values(spark.table("switched.t"), "x", "y") == [(3, 4)]
    assert [t.name for t in spark.catalog.listTables("switched")] == ["t"]
    spark.sql("DROP DATABASE switched CASCADE")


def test_range_ends_are_bounded(spark):
    df = spark.range(5000).selectExpr("id", "CAST(id % 3 AS STRING) AS few", "CAST(NULL AS INT) AS none")
    assert len(range_ends(df, "id", 4)) == 15 and range_ends(df, "none") == []
    assert set(range_ends(df, "few")) <= {"0", "1", "2"}
    assert 10 < len(range_ends(df, "id", 4, sample_rows=500)) <= 15
    place = df.select(z_order(df, ["id", "few", "none"]).alias("z"))
    assert place.where("z IS NULL").count() == 0 and place.distinct().count() > 100


def test_a_range_on_any_index_reads_few_files(spark):
    """Files whose range of the second index meets a filter, before and after."""
    spark.sql("CREATE DATABASE IF NOT EXISTS curved")
    base = {
        "name": "t", "schema": "curved", "strategy": "replace",
        "sql": "SELECT id AS a, CAST((id * 7919) % 100000 AS BIGINT) AS b FROM range(100000)",
    }

    def met(column, low, high):
        names = [f.removeprefix("file:") for f in spark.table("curved.t").inputFiles()]
        hits = 0
        for f in names:
            meta = pq.ParquetFile(f).metadata
            at = meta.schema.names.index(column)
            stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            hits += any(s.min <= high and s.max >= low for s in stats)
        return hits / len(names)

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        first = [{"name": "i", "columns": ["a"]}]
        materialize(spark, [{**base, "indexes": first}], "curved")
        alone = met("a", 1000, 2000), met("b", 1000, 2000)
        materialize(spark, [{**base, "indexes": [*first, {"name": "j", "columns": ["b"]}]}], "curved")
        both = met("a", 1000, 2000), met("b", 1000, 2000)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert alone[1] == 1.0 and both[0] < 0.4 and both[1] < 0.4
    spark.sql("DROP DATABASE curved CASCADE")
