import random

import pytest
from edges import DOCUMENTS, documents, words
from pyspark.sql import functions as F

from cubestar.llm import mixing


def iterated(sizes, weights=(1, 2, 3), cap=3):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in stopped]
        left = total - sum(cap * sizes[s] for s in stopped)
        shares = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if shares[s] > cap * sizes[s]}
        if not over:
            return shares | {s: float(cap * sizes[s]) for s in stopped}
        stopped |= over


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 80, 1000]) for i in range(rng.randint(2, 12))} | {None: 7, "Ü": 3}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    for source, target in iterated(sizes).items():
        assert got[source] == pytest.approx(target)


def test_taken_is_near_its_target(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(0, 60), "x", rng.choice(["a", "a", "a", "b", "c", None])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    sizes, plan = mixing.mix_plan(docs)
    taken = mixing.with_copies(sizes, plan)
    sums = taken.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most"), F.max("size").alias("largest"))
    for r in sums.collect():
        assert abs(r["taken"] - r["target"]) <= r["largest"] and r["most"] <= 3
    again = mixing.with_copies(*mixing.mix_plan(docs))
    assert taken.exceptAll(again).isEmpty()


def test_edges(spark):
    docs = documents(spark)
    sizes, plan = mixing.mix_plan(docs)
    got = mixing.with_copies(sizes, plan).collect()
    assert sorted(r["size"] for r in got) == sorted(len(words(t)) for _, t, *_ in DOCUMENTS)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got)


def test_empty_table_and_empty_texts(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert all(r["target"] == 0 for r in mixing.with_copies(*mixing.mix_plan(empty)).collect())
