"""Dense ids that are kept over loads."""

import re

import pytest
from pyspark.sql import functions as F

from cubestar.operators.surrogates import PLACE_KEY, dense_ids, give_ids, placed, with_content_keys
from cubestar.plans.load import load_batch, load_into, load_metadata, save_metadata
from cubestar.schema import MEMBER_TABLES, empty_star
from cubestar.sources.star_tables import create_star, read_star
from cubestar.sources.versions import committed, drop_old_versions
from cubestar.sources.workdir import stage
from helpers import D2, cube, metadata, observations, values


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_ids_have_no_gaps(spark, partitions):
    """Whatever the partitions hold: most rows in one, many empty, some rows known."""
    rows = spark.range(500).select(F.col("id").alias("key"))
    skewed = rows.repartition(partitions, F.when(F.col("key") % 10 > 0, 0).otherwise(F.col("key")))
    written = stage(placed(skewed), "placed")
    some = written.where("key % 3 = 0")
    assert sorted(r.id for r in dense_ids(written, after=7).collect()) == list(range(8, 508))
    assert sorted(r.id for r in dense_ids(some).collect()) == list(range(1, 168))
    assert dense_ids(written.limit(0)).count() == 0


def test_no_task_numbers_all_rows(spark):
    """Windows over rows go by the partition of the write; the other sees its counts."""
    written = stage(placed(spark.range(10).select(F.col("id").alias("key"))), "placed")
    plan = dense_ids(written)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    windows = [i for i, line in enumerate(plan) if "Window [" in line]
    assert len(windows) == 2
    assert "row_number" in plan[windows[0]] and re.search(r"\], \[_part#\d+L\], \[_at#", plan[windows[0]])
    assert "Aggregate" in plan[windows[1] + 1]


def test_only_new_keys_get_ids(spark):
    known = spark.createDataFrame([(5, "N6", "", "a", ""), (2, "N6", "", "b", "")], empty_star(spark).localidade.schema)
    wanted = spark.createDataFrame([("N6", c) for c in "abcd"], "nc string, d1c string").selectExpr(
        f"{PLACE_KEY} AS key", "nc", "'' AS nn", "d1c", "'' AS d1n"
    )
    ids, fresh = give_ids(known, wanted, PLACE_KEY)
    assert sorted(r.id for r in ids.collect()) == [2, 5, 6, 7]
    assert sorted(values(fresh, "id")) == [(6,), (7,)] and {r.d1c for r in fresh.collect()} == {"c", "d"}


BATCHES = (
    [{"D1C": c, "D4C": k, "D4N": k} for c in "abc" for k in ("1", "2")],
    [{"D1C": c, "D4C": k, "D4N": "renamed", "V": "2", "modificacao": D2} for c in "bcd" for k in ("2", None)],
)


def test_loads_keep_ids(spark, tmp_path):
    path = str(tmp_path / "star")
    create_star(spark, path)
    save_metadata(spark, path, metadata(spark, cube("1")))
    seen = {}
    for rows in BATCHES:
        load_into(spark, path, observations(spark, *rows))
        save_metadata(spark, path, metadata(spark, cube("1", periods=("202002", "202003"))))
        star = read_star(spark, path)
        for name in MEMBER_TABLES:
            now = {tuple(map(str, r[1:3])) if name == "periodo" else tuple(r[1:]): r.id for r in getattr(star, name).collect()}
            before = {k[:2] if name == "periodo" else k: v for k, v in seen.get(name, {}).items()}
            assert all(now[k] == v for k, v in before.items())
            assert sorted(now.values()) == list(range(1, len(now) + 1))
            seen[name] = now
    assert [t for _, t in star.dados.dtypes][:2] == ["bigint", "bigint"]


def test_stars_that_grew_apart(spark):
    """The order of loads changes ids and nothing else."""
    described = load_metadata(empty_star(spark), metadata(spark, cube("1")))
    results = []
    for order in (BATCHES, BATCHES[::-1]):
        star = described
        for rows in order:
            star = load_batch(star, observations(spark, *rows)).star
        results.append(sorted(map(str, with_content_keys(star, star.dados).drop("ativo").collect())))
    assert results[0] == results[1] and len(results[0]) == 12


def test_descriptions_switch_at_once(spark, tmp_path, monkeypatch):
    """A load that fails on the way leaves the version before; a reader keeps its files."""
    from cubestar.sources import star_tables

    path = str(tmp_path / "star")
    create_star(spark, path)
    save_metadata(spark, path, metadata(spark, cube("1")))
    reader = read_star(spark, path)
    monkeypatch.setattr(star_tables, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        save_metadata(spark, path, metadata(spark, cube("1"), cube("2")))
    monkeypatch.undo()
    assert values(read_star(spark, path).tabela_sidra, "id") == [("1",)]
    save_metadata(spark, path, metadata(spark, cube("1"), cube("2")))
    assert sorted(values(read_star(spark, path).tabela_sidra, "id")) == [("1",), ("2",)]
    assert values(reader.tabela_sidra, "id") == [("1",)]
    assert len(committed(spark, f"{path}/described")) == 3
    assert len(drop_old_versions(spark, f"{path}/described")) == 1
    assert read_star(spark, path).tabela_sidra.count() == 2


def test_ambiguous_periods_are_reported(spark):
    monthly, half = cube("1"), cube("2", frequency="semestral", periods=("202001",))
    half["periodos"][0]["literals"] = ["first half"]
    star = load_metadata(empty_star(spark), metadata(spark, monthly, half))
    pairs = spark.createDataFrame([("mensal", "mensal"), ("mensal", "semestral")], "periodicidade string, frequencia string")
    batch = observations(spark, {}, {"D3C": "202002"}, {"D1C": "2"}, {"D3C": "none"})
    report = load_batch(star, batch, pairs).report.first()
    assert (report.staged, report.missing_periods, report.ambiguous_periods) == (3, 1, 2)
    assert load_batch(star, batch).report.first().ambiguous_periods == 0
