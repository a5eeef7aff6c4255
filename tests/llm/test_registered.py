"""Registered queries against DuckDB or plain Python on the smallest tables."""

import zlib

import numpy as np
import pytest
import xxhash
from compare import differences
from edges import LOWER, roots, same_rows, words
from test_quality import expected_counts
from test_suffix_dedup import brute_force

from cubestar.llm.queries import ORACLES, QUERIES
from cubestar.llm.tokenizing import vocabulary_path


@pytest.fixture(scope="module")
def docs(spark, sf):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, sf, name):
    problem, n = differences(QUERIES[name](spark, sf), con, ORACLES[name])
    assert problem == "" and n


def test_op2(spark, sf, docs):
    """Offsets of another library over the same vocabulary."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    got = {r["doc_id"]: r for r in QUERIES["op2_token_attribution"](spark, sf).collect()}
    for doc_id, text in docs:
        offsets = tokenizer.encode(text, add_special_tokens=False).offsets
        lines, at = [], 0
        for line in text.split("\n"):
            lines.append((at, min(at + len(line) + 1, len(text))))
            at += len(line) + 1
        lines = [x for x in lines if x[0] < x[1]]
        counts = [0] * len(lines)
        for a, b in offsets:
            share = [min(b, e) - max(a, s) for s, e in lines]
            counts[share.index(max(share))] += 1
        row = got[doc_id]
        assert row["n_tokens"] == len(offsets) and row["section_tokens"] == counts


def test_op3(spark, sf):
    got = {r["doc_id"]: r for r in QUERIES["op3_toxicity"](spark, sf).collect()}
    for doc_id, row in got.items():
        assert row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert row["predicted"] == int(row["score"] >= 0.7) and 0 <= row["score"] <= 1


def test_op3_held_out_accuracy(spark):
    """Few false alarms and most toxic documents, on rows that were not learned from."""
    sf = "/root/testdata/sf0.1"
    scored = QUERIES["op3_toxicity"](spark, sf).where("held_out")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    counts = {(r["toxic"], r["predicted"]): r["count"] for r in scored.join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()}
    assert counts[1, 1] / (counts[1, 1] + counts.get((1, 0), 0)) > 0.75
    assert counts.get((0, 1), 0) / counts[0, 0] < 0.01


def simhash(text):
    own = words((text or "").translate(LOWER))
    if not own:
        return 0
    shingles = [" ".join(own[i : i + 4]) for i in range(len(own) - 3)] or [" ".join(own)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op4(spark, sf, docs):
    docs = sorted(docs)
    values = np.array([simhash(t) for _, t in docs], np.uint64)
    pairs = [
        (i, int(j)) for i in range(len(docs)) for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 4) if i < j
    ]
    root = roots(len(docs), pairs)
    expected = [(d, f"{v:016x}", docs[r][0]) for (d, _), v, r in zip(docs, values.tolist(), root)]
    assert same_rows(QUERIES["op4_simhash"](spark, sf).collect(), expected)


def test_op5(spark, sf, docs):
    got = {r["doc_id"]: r for r in QUERIES["op5_fertility"](spark, sf).collect()}
    for doc_id, text in docs:
        row = got[doc_id]
        assert tuple(row)[1:7] == expected_counts(text)
        assert row["kept"] == (row["reason"] is None)


def test_op5_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    judged = QUERIES["op5_fertility"](spark, sf).where("NOT base_failed")
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1")
    assert judged.join(labels, "doc_id").where("NOT kept").count() == 0


def test_op6(spark, sf, docs):
    assert same_rows(QUERIES["op6_suffix_dedup"](spark, sf).collect(), brute_force(docs))


def test_op7(spark, sf, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    expected, start = [], 0
    for doc_id, text in sorted(docs):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert same_rows(QUERIES["op7_token_planes"](spark, sf).collect(), expected)


def test_op10(spark, sf, docs):
    """All items against all documents at every alignment."""
    items = [(r["item_id"], words(r["text"].translate(LOWER))) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    expected = set()
    for doc_id, text in docs:
        own = words(text.translate(LOWER))
        places = {}
        for i, w in enumerate(own):
            places.setdefault(w, []).append(i)
        for item_id, item in items:
            window = min(20, len(item))
            shifts = {p - i for i, w in enumerate(item) for p in places.get(w, ())}
            for shift in shifts:
                equal = [0 <= i + shift < len(own) and own[i + shift] == w for i, w in enumerate(item)]
                best = max(sum(equal[i : i + window]) for i in range(len(item) - window + 1))
                if best >= window - window // 5:
                    expected.add((doc_id, item_id))
    got = QUERIES["op10_decontaminate"](spark, sf).select("doc_id", "item_id").collect()
    assert same_rows(got, expected) and expected
