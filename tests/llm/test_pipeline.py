import numpy as np
from edges import documents

import corpus_pipeline
from cubestar.llm import decontaminate, mixing, quality, simhash
from test_registered import simhash as plain_simhash


def test_stages_on_their_own_input(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        before = docs
        step(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = before, docs
        assert name == "token_files" or docs.columns == columns
    before, after = kept["quality_rules"]
    good = {r["doc_id"] for r in quality.assess(before, carry=["doc_id"]).where("kept").collect()}
    assert {r["doc_id"] for r in after.collect()} == good
    before, after = kept["near_duplicates"]
    fps = {r["doc_id"]: plain_simhash(r["text"]) for r in before.collect()}
    left = {r["doc_id"] for r in after.collect()}
    values = np.array([fps[d] for d in sorted(left)], np.uint64)
    for i in range(len(values)):
        assert not (np.bitwise_count(values[i + 1 :] ^ values[i]) <= simhash.MAX_BITS).any()
    for d, v in fps.items():
        assert d in left or any(e < d and (v ^ w).bit_count() <= 4 for e, w in fps.items()) or any((v ^ w).bit_count() <= 4 for e, w in fps.items() if e != d)
    before, after = kept["benchmark_decontamination"]
    bad = {r["doc_id"] for r in decontaminate.overlaps(before, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()} - bad
    before, after = kept["source_mix"]
    assert after.count() == mixing.mix(before).count()
    before, after = kept["token_files"]
    assert after.count() == before.count()


def test_edges(spark, sf, tmp_path):
    for rows in (None, []):
        docs = documents(spark, rows)
        columns = docs.columns
        for name, step in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{rows is None}")
            step(spark, docs, sf).write.parquet(path)
            docs = spark.read.parquet(path)
            assert name == "token_files" or docs.columns == columns


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0
