"""What keeps a load within its disk and time: few files, freed folders, narrow joins."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cubestar.catalog import inputs
from cubestar.operators import lookups, surrogates
from cubestar.operators.surrogates import with_member_ids
from cubestar.plans.load import load_batch, load_into, load_metadata, save_metadata
from cubestar.schema import empty_star
from cubestar.sources import documents
from cubestar.sources.documents import latest_documents, observations_from_documents
from cubestar.sources.split_documents import split_records
from cubestar.sources.star_tables import create_star, read_star
from cubestar.sources.workdir import shared_dir
from helpers import D1, cube, metadata, observations, values


def test_documents_are_rows_of_few_files(spark, sf):
    files = [f for f in Path(inputs.landing(spark, sf)).rglob("*") if f.suffix == ".parquet"]
    found = inputs.documents(spark, sf)
    assert len(files) < 100 < found.count()
    assert found.where("file_path LIKE '%metadados.json' OR file_path NOT LIKE 't-%/t-%@%.json'").isEmpty()


def test_publications_are_read_over_one_stored_table(spark, sf):
    folders = {f.rsplit("/", 2)[-2] for n in ("old_batch", "new_batch") for f in inputs.source(spark, sf, n).inputFiles()}
    assert len(folders) == 1
    stored, again = inputs.source(spark, sf, "new_batch"), inputs.derive(spark, sf, "new_batch")
    assert stored.columns == again.columns
    assert stored.exceptAll(again).isEmpty() and again.exceptAll(stored).isEmpty()


def docs(spark, *names):
    rows = [(f"t-1/{n}", f'[{{"V": "Value"}}, {{"V": "{i}"}}]') for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "file_path string, value string")


@pytest.mark.parametrize("clash", [False, True])
def test_many_latest_documents_meet_by_hash(spark, monkeypatch, clash):
    """No text is shuffled beyond the number of broadcast paths, and equal hashes do no harm."""
    monkeypatch.setattr(documents, "MAX_PATHS", 0)
    if clash:
        monkeypatch.setattr(documents, "_path_hash", lambda: F.lit(1).cast("bigint"))
    landed = docs(spark, "a@2024-01-01.json", "a@2024-02-01.json", "b.json", "a@2024-01-15.json", "b.json")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        latest = latest_documents(landed)
        plan = latest._jdf.queryExecution().executedPlan().toString()
        assert sorted(values(latest, "file_path")) == [("t-1/a@2024-02-01.json",), ("t-1/b.json",), ("t-1/b.json",)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_descriptor_is_read_once_per_document(spark):
    rows = observations_from_documents(docs(spark, "t-9_p-1@2024-01-01.json"))
    assert rows.columns[-2:] == ["tabela_sidra_id", "modificacao"]
    assert [tuple(r) for r in rows.select("tabela_sidra_id", "modificacao", "V").collect()] == [("9", D1, "0")]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan.split("Generate")[0]


def test_blocks_of_whole_rows_are_not_listed(spark, sf, monkeypatch):
    """Pieces of one block and of many give the same rows; only blocks behind the first are joined."""
    def all_of(size):
        monkeypatch.setattr(inputs, "PIECES_PER_BLOCK", size)
        found = split_records(inputs.document_pieces(spark, sf).where("file_path LIKE 't-T1/%'"))
        return found, found.agg(F.count("*"), F.sum("pos"), F.sum(F.xxhash64("file_path", "pos", "record").cast("decimal(38,0)"))).first()

    (whole, one), (_, many) = all_of(1 << 30), all_of(7)
    assert one == many and one[0] > 1000
    assert "Aggregate" not in whole._jdf.queryExecution().optimizedPlan().toString()


def test_a_load_leaves_only_its_report(spark, tmp_path):
    star = str(tmp_path / "star")
    create_star(spark, star)
    save_metadata(spark, star, metadata(spark, cube()))
    folder = Path(shared_dir(spark).removeprefix("file://"))
    before = set(os.listdir(folder)) if folder.exists() else set()
    report = load_into(spark, star, observations(spark, {}, {"D1C": "101"}))
    left = {f.rsplit("-", 1)[0] for f in set(os.listdir(folder)) - before}
    assert left == {"report"}
    assert values(report, "staged", "inserted") == [(2, 2)]
    assert read_star(spark, star).dados.count() == 2


def test_many_members_are_joined_by_hash(spark, monkeypatch):
    cells = spark.createDataFrame([("p1", "m1", "7"), ("p2", "m1", "8")], "localidade_key string, dimensao_key string, v string")
    ids = spark.createDataFrame([("p1", 1), ("p2", 2)], "key string, id long")
    members = spark.createDataFrame([("m1", 5)], "key string, id long")
    monkeypatch.setattr(surrogates, "MAX_KEYS", 0)
    for most in (0, 10):
        monkeypatch.setattr(surrogates, "MAX_HASHES", most)
        found = with_member_ids(cells, ids, members)
        assert sorted(values(found, "localidade_id", "dimensao_id", "v")) == [(1, 5, "7"), (2, 5, "8")]


def test_many_cubes_are_cut_to_those_of_the_batch(spark, monkeypatch):
    star = load_metadata(empty_star(spark), metadata(spark, *(cube(id=str(i)) for i in range(1, 9))))
    batch = observations(spark, {"tabela_sidra_id": "2"}, {"tabela_sidra_id": None, "D1C": "101"})
    expected = sorted(map(str, load_batch(star, batch).report.collect()))
    monkeypatch.setattr(lookups, "MAX_CUBES", 3)
    seen = []
    kept = lookups.broadcast_if_small
    monkeypatch.setattr(lookups, "broadcast_if_small", lambda df, *a, **k: seen.append(df.count()) or kept(df, *a, **k))
    assert sorted(map(str, load_batch(star, batch).report.collect())) == expected
    assert seen[0] == 1
