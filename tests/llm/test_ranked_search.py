import math
import random
import re
from collections import Counter

import pytest
from edges import DOCUMENTS, LOWER, documents, plain

from cubestar.llm import ranked_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(rows, items, k=10):
    docs = [(d, Counter(terms(t))) for d, t in rows]
    docs = [(d, c) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, wanted in asked.items():
        scored = []
        for d, c in docs:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in wanted if t in c
            )
            if score > 0:
                scored.append((-score, d is None, d or 0))
        for rank, (s, null, d) in enumerate(sorted(scored)[:k], 1):
            out.append((i, rank, None if null else d, -s))
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


ITEMS = [
    (1, "a passage of ORDINARY words, a tiny one"), (2, None), (3, ""), (4, "... --- !!!"), (5, "ünïcödé 漢字かな交じり文"),
    (6, "nowhere"), (None, "one two three"), (7, "istanbul İSTANBUL"), (1, "copies told apart"), (8, "aaa " * 9), (8, "aaa " * 9),
]


def test_edges(spark):
    rows = [(d, t) for d, t, *_ in DOCUMENTS]
    got = ranked_search.search(documents(spark), items_of(spark, ITEMS)).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, ITEMS)


def test_empty_tables(spark):
    none = items_of(spark, [])
    assert ranked_search.search(documents(spark), none).count() == 0
    assert ranked_search.search(plain(spark, []), items_of(spark, ITEMS)).count() == 0


@pytest.mark.parametrize("seeds, bucket, block_terms", [(5, 7, 10_000), (40, 2048, 60)])
def test_random(spark, monkeypatch, seeds, bucket, block_terms):
    """Small buckets, few seeds and several blocks of items give the same ranks."""
    monkeypatch.setattr(ranked_search, "BUCKET", bucket)
    rng = random.Random(seeds)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 120)))) for i in range(600)]
    rows += [(1000 + i, rows[i % 5][1]) for i in range(60)]  # ties
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 25)))) for i in range(40)]
    got = ranked_search.search(plain(spark, rows), items_of(spark, items), seeds=seeds, block_terms=block_terms).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, items)


def test_bounds_prune():
    """Documents without an item's large coordinates are never scored."""
    import numpy as np

    best = [ranked_search._Best(1, 50)]
    scored = []
    best[0].add = lambda scores, ids: scores and scored.extend(ids)
    row, term, impact = np.array([0, 0, 1, 2]), np.array([0, 1, 1, 1]), np.array([60, 5, 5, 6])
    lengths = np.sqrt(np.array([60**2 + 25, 25, 36.0]))
    ranked_search._bucket(best, [np.array([0, 1])], np.array([0, 1]), np.array([0]), row, term, impact, lengths, ["x", "y", "z"])
    assert scored == ["x"]
