import random

import numpy as np
import pytest
from edges import DOCUMENTS, documents, plain, roots

from cubestar.llm import simhash
from cubestar.llm.components import connected_components
from test_registered import simhash as plain_simhash


def expected(rows):
    values = [plain_simhash(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4]
    root = roots(len(rows), pairs)
    ids = {}
    for (d, _), r in zip(rows, root):
        known = [x for x in (ids.get(r), d) if x is not None]
        ids[r] = min(known) if known else None
    return [(d, f"{v:016x}", ids[r]) for (d, _), v, r in zip(rows, values, root)]


def test_edges(spark):
    rows = [(d, t) for d, t, *_ in DOCUMENTS]
    got = [tuple(r) for r in simhash.near_duplicates(documents(spark)).collect()]
    assert sorted(got, key=str) == sorted(expected(rows), key=str)


def test_keep_one(spark):
    docs = documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(d, t) for d, t, *_ in DOCUMENTS]
    values = [plain_simhash(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4]
    root = roots(len(rows), pairs)
    least = {}
    for (d, t), r in zip(rows, root):
        least[r] = min(least.get(r, (True, 0)), (d is None, d or 0))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted(least.values())
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_empty_table(spark):
    assert simhash.near_duplicates(plain(spark, [])).count() == 0


def near_family(n=150):
    rng = random.Random(7)
    values = {rng.getrandbits(64) for _ in range(60)}
    for center in (rng.getrandbits(64), 0, (1 << 64) - 1):
        for _ in range(n):
            v = center
            for b in rng.sample(range(64), rng.randint(0, 5)):
                v ^= 1 << b
            values.add(v)
    return sorted(values)


@pytest.mark.parametrize("block, max_blocks", [(1024, 128), (8, 128), (8, 1)])
def test_links_keep_components(spark, block, max_blocks):
    """Small postings, postings in blocks, and the way for crowded ones."""
    values = near_family()
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = {(r["a"], r["b"]) for r in simhash.links(frame, block, max_blocks).collect()}
    at = {v: i for i, v in enumerate(signed)}
    got = roots(len(values), [(at[a], at[b]) for a, b in links])
    pairs = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4]
    assert got == roots(len(values), pairs)
    assert len(links) < len(values) * 30


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    n = 120
    pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.choice([30, 80, 200]))]
    pairs += [(i, i + 1) for i in range(80, 119)] if seed == 2 else []
    frame = spark.createDataFrame(pairs + pairs[:5], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(frame).collect()}
    root = roots(n, pairs)
    assert got == {x: root[x] for a, b in pairs if a != b for x in (a, b)}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
