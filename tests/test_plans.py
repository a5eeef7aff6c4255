"""What the physical plans must and must not contain."""

import pytest

from cubestar.functions.codes import null_sentinels
from cubestar.operators.dimensions import distinct_dimensions, distinct_places
from cubestar.operators.facts import merge_touched, of_cubes, touched_partitions
from cubestar.operators.lookups import resolve_by_content
from cubestar.operators.outputs import annual_summary, flatten
from cubestar.plans.load import insert_members, load_batch, load_into, load_metadata, save_metadata
from cubestar.plans.presets import SUMMARY_COLUMNS, flat_output
from cubestar.schema import empty_star
from cubestar.sources.documents import explode_documents, latest_documents, list_documents, read_documents
from cubestar.sources.star_tables import create_star, read_star
from cubestar.sources.workdir import broadcast_if_small
from helpers import cube, metadata, observations, values


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "star")
    create_star(spark, path)
    save_metadata(spark, path, metadata(spark, cube("1"), cube("2")))
    load_into(spark, path, observations(spark, {}, {"D3C": "202002"}, {"tabela_sidra_id": "2"}))
    return read_star(spark, path)


def test_merge_prunes_stored_partitions(spark, stored):
    batch = null_sentinels(observations(spark, {"V": "2"}))
    rows = resolve_by_content(batch, stored.periodo, stored.tabela_sidra, keep_names=True)
    *_, cells = insert_members(stored, rows)
    merged = merge_touched(stored.dados, cells, latest=touched_partitions(cells))
    text = plan(merged)
    facts = [line for line in text.splitlines() if "FileScan" in line and "dimensao_id" in line]
    assert facts and all("tabela_sidra_id" in line.split("PartitionFilters:")[1] for line in facts)


def test_merge_prunes_without_broadcasts(spark, stored):
    """Only files of the batch's cube are read, whatever joins are chosen."""
    batch = null_sentinels(observations(spark, {"V": "2"}))
    rows = resolve_by_content(batch, stored.periodo, stored.tabela_sidra, keep_names=True)
    *_, cells = insert_members(stored, rows)
    read = of_cubes(stored.dados, touched_partitions(cells))
    assert all("tabela_sidra_id=1/" in f for f in read.select("_metadata.file_path").distinct().toPandas()["file_path"])
    assert of_cubes(stored.dados, touched_partitions(cells), 0).count() == stored.dados.count() > read.count()


def test_flat_output_filters_partitions(stored):
    text = plan(flat_output(stored, ["1"]))
    facts = next(line for line in text.splitlines() if "FileScan" in line and "dimensao_id" in line)
    assert "tabela_sidra_id" in facts.split("PartitionFilters:")[1]
    assert "modificacao" not in facts.split("ReadSchema:")[1]


def test_first_rows_shrink_before_they_are_sorted(spark):
    rows = observations(spark, {"file_path": "f", "pos": 1}, extra=("file_path", "pos"))
    for df in (distinct_places(rows), distinct_dimensions(rows)):
        text = plan(df)
        assert "HashAggregate" in text and "Window" not in text


def test_document_texts_are_not_shuffled(spark, tmp_path):
    (tmp_path / "t-1_p-1@1.json").write_text('[{}, {"V": "1"}]')
    docs = latest_documents(read_documents(spark, str(tmp_path)), list_documents(spark, str(tmp_path)))
    text = plan(explode_documents(docs))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_summary_combines_before_the_shuffle(stored):
    assert "partial_sum" in plan(annual_summary(flatten(stored, ["1"], SUMMARY_COLUMNS)))


def test_large_sides_are_not_hinted(spark):
    side = spark.range(10)
    assert "broadcast" not in broadcast_if_small(side, 9)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" in broadcast_if_small(side, 10)._jdf.queryExecution().logical().toString().lower()


def test_results_do_not_depend_on_broadcasts(spark, monkeypatch):
    rows = [{"D1C": "hot" if i % 3 else str(i), "D4C": str(i), "D4N": str(i), "V": str(i)} for i in range(60)]

    def flat():
        star = load_metadata(empty_star(spark), metadata(spark, cube("1")))
        star = load_batch(star, observations(spark, *rows)).star
        return sorted(values(flat_output(star, ["1"]), "localidade_id", "categoria", "valor"))

    usual = flat()
    for module in ("operators.lookups", "operators.facts", "operators.surrogates"):
        monkeypatch.setattr(f"cubestar.{module}.broadcast_if_small", lambda df, *a, **k: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert flat() == usual and len(usual) == 60
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
