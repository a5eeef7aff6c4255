import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from edges import same_rows

from cubestar.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, `pos` int, `h` int, `seq` string, `depth` int, `e1` int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3, 4) for r in rows], SCHEMA)


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), (role or "").encode(), (text or "").encode()))
    own = {c: [(r.decode(), t.decode()) for _, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        family = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(family, [])[:h] + turns[h:]
    return out


def expected(rows):
    members = defaultdict(list)
    conversations = rebuilt(rows)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        below = [totals[k] for k in children[node]]
        totals[node] = (own + sum(s for s, _ in below), sum(n for _, n in below) or 1)
    out = []
    for node, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if tuple(conversations[c]) == node)
        parent = min(members[node[:-1]]) if node else None
        saved, leaves = totals[node]
        out.append((
            min(held), len(node), parent, len(held), len(children[node]), leaves, saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


EDGES = [
    (0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, 2, "user", "c"),
    (1, 1, "assistant", None), (1, None, "user", "first"), (1, 1, None, "b"), (1, 1, None, "b"),
    (2, 5, "user", "lone"), (None, 0, "user", "nobody"), (None, None, None, None),
    (100, 0, "", ""), (101, 0, None, None), (150, 7, "user", "x" * 200_000), (-7, 0, "user", "neg"), (-107, 0, "user", "é漢🎉"),
    (250, 0, "user", "no head"), (251, 0, "user", "no head"), (251, 1, "user", "no head"),
]


def test_edges(spark):
    got = prefix_trie.conversation_trie(table(spark, EDGES)).collect()
    assert same_rows(got, expected(EDGES))


def test_empty_table(spark):
    assert prefix_trie.conversation_trie(table(spark, [])).count() == 0
    assert prefix_trie.conversation_trie(table(spark, [(None, 1, "user", "x")])).count() == 0


def test_turnless_conversations(spark):
    """Conversations without own turns after the shared ones, and without a head."""
    rows = [(c, 0, "user", "t") for c in range(1, 60)]
    want = expected(rows)
    assert any(d == 0 and k for _, d, _, _, k, *_ in want)
    assert same_rows(prefix_trie.conversation_trie(table(spark, rows)).collect(), want)


@pytest.mark.parametrize("block", [3, 256])
def test_random(spark, monkeypatch, block):
    """Shared beginnings, copies, a long conversation over many ranges and blocks."""
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rng = random.Random(block)
    rows = []
    for c in rng.sample(range(-300, 900), 150):
        for turn in range(rng.randrange(1, 9)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["p", "qq", "rrr"])))
    rows += [(902, turn, "user", f"{turn % 7}") for turn in range(700)]
    rng.shuffle(rows)
    got = prefix_trie.conversation_trie(table(spark, rows).repartition(5)).collect()
    assert same_rows(got, expected(rows))
