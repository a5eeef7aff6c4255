"""Documents that are read in parts give the rows of whole documents."""

import json
import random

import pytest

from cubestar.sources.documents import explode_documents, read_documents
from cubestar.sources.split_documents import read_pieces, read_rows, rows_of_records, split_records
from helpers import values

NASTY = ['}', '},{', '"', '\\', '\\"}', '{"V": "x"}', "a\nb", "é漢🎉", "...", "-", "", "],[", "}" * 5, '\\\\']


def document(n, seed=0):
    rng = random.Random(seed)
    rows = [{"V": "Value", "D1N": "header } with { braces"}]
    for i in range(n):
        rows.append({"V": str(i), "D1C": rng.choice(NASTY), "D1N": "x" * rng.randrange(40) + rng.choice(NASTY), "NC": None})
    return rows


def land(folder, name, rows, **how):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(rows, **how), encoding="utf-8")


def everything(df):
    return sorted(map(str, values(df, "file_path", "pos", "V", "D1C", "D1N", "NC")))


@pytest.mark.parametrize("block", [200, 997, 20_000])
@pytest.mark.parametrize("how", [{}, {"indent": 2}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_same_rows_as_whole_documents(spark, tmp_path, block, how):
    """Blocks much smaller than a document; cuts fall into texts and escapes."""
    folder = tmp_path / "t-1"
    land(folder, "t-1_p-1@2024-01-01.json", document(300), **how)
    land(folder, "t-1_p-2@2024-01-01.json", document(40, 5), **how)
    land(folder, "t-1_p-3@2024-01-01.json", [], **how)
    land(folder, "t-1_p-4@2024-01-01.json", [{"V": "only a header }"}], **how)
    whole = everything(explode_documents(read_documents(spark, str(tmp_path))))
    settings = {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": "0"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        pieces = read_pieces(spark, str(tmp_path))
        assert block > 10_000 or pieces.rdd.getNumPartitions() > 8
        assert everything(rows_of_records(split_records(pieces))) == whole
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert len(whole) == 340


def test_blocks_beyond_a_broadcast(spark, tmp_path, monkeypatch):
    from cubestar.sources import split_documents

    monkeypatch.setattr(split_documents, "MAX_BLOCKS", 0)
    land(tmp_path / "t-1", "t-1_p-1@2024-01-01.json", document(200))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = everything(rows_of_records(split_records(read_pieces(spark, str(tmp_path)))))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == everything(explode_documents(read_documents(spark, str(tmp_path))))


def test_large_documents_are_read_in_parts(spark, tmp_path):
    """No task holds the large document: it is many times a partition's bytes."""
    folder = tmp_path / "t-1"
    rows = [{"V": "Value"}] + [{"V": str(i), "D1C": str(i % 97), "D1N": f"place {i} }}"} for i in range(120_000)]
    land(folder, "t-1_p-1@2024-01-01.json", rows)
    land(folder, "t-1_p-2@2024-01-01.json", document(3))
    land(folder, "metadados.json", {"id": "1"})
    size = (folder / "t-1_p-1@2024-01-01.json").stat().st_size
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        df = read_rows(spark, str(tmp_path), whole_bytes=100_000)
        assert size > 20 * (256 << 10)
        got = df.selectExpr("count(*)", "sum(CAST(V AS BIGINT))", "max(pos)", "count(distinct D1C)").first()
        assert got[0] == 120_003 and got[1] == sum(range(120_000)) + 3 and got[2] == 120_000
        assert sorted(r.pos for r in df.where("file_path LIKE '%p-2%'").collect()) == [1, 2, 3]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_broken_record_stops_the_job(spark, tmp_path):
    (tmp_path / "t-1_p-1@a.json").write_text('[{"V": "1"}, {"V": oops}]', encoding="utf-8")
    with pytest.raises(Exception):
        rows_of_records(split_records(read_pieces(spark, str(tmp_path)))).collect()
