from itertools import combinations

import numpy as np
import pytest
from edges import DOCUMENTS, PROSE, documents

from cubestar.llm import decontaminate as d

ITEM = " ".join(f"w{i}" for i in range(30))


def bench(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "item_id long, text string, at int, codes string")


def pairs(docs, benchmark):
    return {(r["doc_id"], r["item_id"]) for r in d.overlaps(docs, benchmark).collect()}


@pytest.mark.parametrize("window", range(d.MIN_ITEM_WORDS, d.WINDOW + 1))
def test_masks_meet_every_window(window):
    """Any allowed set of replaced words leaves one seed whole."""
    seeds = [sum(1 << (p + at) for p in m) for m in d.masks_of(window) for at in range(window - m[-1])]
    for replaced in combinations(range(window), int(d.MAX_REPLACED * window)):
        bits = sum(1 << i for i in replaced)
        assert any(not bits & s for s in seeds)


def test_substitutions(spark):
    def changed(*at):
        return " ".join("other" if i in at else f"W{i}" for i in range(30))

    texts = [changed(), changed(3, 9, 15, 21, 27), changed(*range(0, 30, 3)), "x y " + changed(5) + " z", "nothing of it"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert pairs(docs, bench(spark, [(1, ITEM)])) == {(0, 1), (1, 1), (3, 1)}


def test_edges(spark):
    docs = documents(spark)
    items = [(1, PROSE), (2, None), (3, ""), (None, PROSE), (4, "too few words here"), (5, "of and the " * 8), (1, PROSE)]
    got = pairs(docs, bench(spark, items))
    with_prose = {i for i, t, *_ in DOCUMENTS if t and "A passage of ordinary" in t}
    assert got == {(i, b) for i in with_prose for b in (1, None)} | {(6, 5)}
    kept = d.remove_contaminated(docs, bench(spark, items))
    assert kept.columns == docs.columns
    assert kept.count() == sum(not (t and ("A passage of ordinary" in t or t.startswith("the of and"))) for _, t, *_ in DOCUMENTS)


def test_empty_tables(spark):
    docs = documents(spark)
    assert d.overlaps(docs, bench(spark, [])).count() == 0
    assert d.overlaps(documents(spark, []), bench(spark, [(1, ITEM)])).count() == 0
    assert d.remove_contaminated(docs, bench(spark, [])).count() == len(DOCUMENTS)


def test_overlap_beyond_the_text():
    item = np.arange(16, dtype=np.uint64)
    assert d.best_overlap(item, item[:13], [0]) == 13
    assert d.best_overlap(item, item[3:], [2, -3]) == 13
