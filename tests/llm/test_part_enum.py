import random

import numpy as np
import pytest
from edges import DOCUMENTS, LOWER, PROSE, documents, plain, roots, words
from hypothesis import given, settings
from hypothesis import strategies as st

from cubestar.llm import part_enum
from cubestar.llm.words import WordHashes, pieces


def shingles(text):
    found = words((text or "").translate(LOWER))
    if len(found) < 3:
        return {" ".join(found)} if found else set()
    return {" ".join(found[i : i + 3]) for i in range(len(found) - 2)}


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])
    ]
    least = {}
    root = roots(len(rows), pairs)
    for (d, _), r in zip(rows, root):
        known = [x for x in (least.get(r), d) if x is not None]
        least[r] = min(known) if known else None
    return [(d, len(s), least[r]) for (d, _), s, r in zip(rows, sets, root)]


def same(left, right):
    return sorted(map(tuple, left), key=str) == sorted(right, key=str)


def test_edges(spark):
    rows = [(d, t) for d, t, *_ in DOCUMENTS]
    assert same(part_enum.similar_sets(documents(spark)).collect(), expected(rows))


def test_empty_table(spark):
    assert part_enum.similar_sets(plain(spark, [])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.integers(9, 300), st.integers(0, 40), st.integers(0, 40), st.integers(0, 1 << 30))
def test_linked_sets_share_a_signature(size, gone, added, seed):
    """Any two sets that link meet, whatever their bands."""
    rng = np.random.default_rng(seed)
    left = np.unique(rng.integers(0, 1 << 64, size, np.uint64))
    right = np.unique(np.concatenate([left[min(gone, len(left) - 1) :], rng.integers(0, 1 << 64, added, np.uint64)]))
    shared = len(np.intersect1d(left, right))
    links = 100 * shared >= 90 * (len(left) + len(right) - shared)
    assert links == (len(left) + len(right) - 2 * shared <= (len(left) + len(right)) // part_enum.REACH)
    if links and not np.array_equal(left, right):
        assert np.intersect1d(part_enum.signatures(left), part_enum.signatures(right)).size
        a, b = (np.frombuffer(part_enum.sketch(x), np.uint64)[None] for x in (left, right))
        w = min(a.shape[1], b.shape[1])
        bits = np.bitwise_count(part_enum._folded(a, w) ^ part_enum._folded(b, w)).sum()
        assert bits <= len(left) + len(right) - 2 * shared


def family(n, rate, length=60, seed=3):
    """Copies of one text with single words replaced at a rate."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(length)]
    return [
        (i, " ".join(w if rng.random() > rate else f"x{rng.randrange(10**6)}" for w in base))
        for i in range(n)
    ]


@pytest.mark.parametrize("rate", [0.004, 0.02])
def test_family(spark, rate):
    """Many near copies around the threshold, in blocks smaller than their groups."""
    rows = family(150, rate) + [(1000 + i, f"{PROSE} {i} {PROSE}") for i in range(40)]
    got = part_enum.similar_sets(plain(spark, rows), block=16).collect()
    want = expected(rows)
    assert same(got, want)
    assert len({c for _, _, c in want}) < len(rows)


def test_chain(spark):
    """Neighbours link, ends do not: one component."""
    tokens = [f"t{i}" for i in range(400)]
    rows = [(i, " ".join(tokens[4 * i : 4 * i + 200])) for i in range(40)]
    got = part_enum.similar_sets(plain(spark, rows)).collect()
    assert {r["component_id"] for r in got} == {0} and same(got, expected(rows))


def test_pieces_keep_words():
    raw = b"ab  cd\tefg " * 50 + b"z" * 300
    assert [w for p in pieces(raw, size=16) for w in p.split()] == raw.split()
    assert b"".join(pieces(raw, size=16)) == raw
    assert WordHashes().of(raw).tolist() == [h for p in pieces(raw, size=16) for h in WordHashes().of(p).tolist()]
