"""Connected components over an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubestar.sources.workdir import stage

MAX_ROUNDS = 60


def _neighbours(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.distinct()


def _star(pairs: DataFrame) -> DataFrame:
    """Each node and neighbour linked with the smallest node of the neighbourhood.

    The smallest neighbour is a partial aggregate and joined back, so a node with
    very many neighbours is never gathered in one row.
    """
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return pairs.join(least, "a")


def connected_components(edges: DataFrame) -> DataFrame:
    """node, root of every node that has an edge; the root is the smallest node.

    ``edges`` has the long columns a and b; direction, repeats and loops do not
    matter. The rounds end when no edge changes; their number grows with the
    logarithm of the number of nodes. Every round starts from a written table.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stage(ordered.distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if current.isEmpty():
            break
        # Large star: larger neighbours move to the smallest of the neighbourhood.
        large = (
            _star(_neighbours(current))
            .where("b > a AND b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        # Small star: the node and its smaller neighbours move likewise.
        smaller = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        starred = _star(smaller)
        moved = starred.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        hubs = starred.select("a", F.col("m").alias("b"))
        after = stage(moved.unionByName(hubs).where("a <> b").distinct(), "edges")
        if _same(current, after):
            break
        current = after
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _same(left: DataFrame, right: DataFrame) -> bool:
    def digest(df):
        h = F.xxhash64("a", "b").cast("decimal(38,0)")
        return tuple(df.agg(F.count("*"), F.sum(h)).first())

    return digest(left) == digest(right)
