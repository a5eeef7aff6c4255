"""Rows at the edges of every contract, and plain versions of the operators."""

from __future__ import annotations

import re
from collections import Counter

BLANK = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "the of and " * 60_000 + "x" * 70_000
PROSE = (
    "A passage of ordinary words that is long enough to hold more than fifty bytes, and that comes"
    " back in other documents with small changes here and there so that copies can be told apart."
)

#: doc_id, text, lang, source and columns whose names operators could use inside.
DOCUMENTS = [
    (1, PROSE, "en", "a", 1, "k"),
    (1, PROSE, "en", "a", 1, "k"),
    (2, PROSE.replace("small", "tiny"), "en", "a", 2, "k"),
    (3, None, "en", "b", 3, None),
    (4, "", None, None, None, None),
    (5, " \t\n\x0b\x0c\r ", "zz", None, 5, "k"),
    (6, LONG, "en", "a", 6, "k"),
    (7, "Ünïcödé — 漢字かな交じり文 🎉 \x1c\x85\xa0 İSTANBUL ẞ", "ja", "c", 7, "k"),
    (None, PROSE, "en", "a", 8, "k"),
    (None, None, None, None, None, None),
    (8, PROSE + "\n" + PROSE + "\n" + PROSE, "de", "b", 9, "k"),
    (9, "a" * 500, "fr", "b", 10, "k"),
    (9, "another text under the same id, with <|endoftext|> and ##### inside of it", "fr", "b", 11, "k"),
    (-3, "one two three", "es", "ü", 12, "k"),
]
SCHEMA = (
    "doc_id long, text string, lang string, source string, `copies` int, `kept` string,"
    " `tag` int, `_tag` int, `row` int, `key` int, `h` int, `place` int, `size` int, `hash` int,"
    " `_text` string, `fp` long, `host` string, `n_tokens` int"
)


def documents(spark, rows=None):
    rows = DOCUMENTS if rows is None else rows
    return spark.createDataFrame([(*r, *range(10, 18), "x", 1, "y", 2)[:18] for r in rows], SCHEMA)


def plain(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def words(text):
    return BLANK.findall(text or "")


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def same_rows(left, right):
    return Counter(map(tuple, left)) == Counter(map(tuple, right))
