"""Mixing sources to target weights by nested hash thresholds.

Sizes are summed by source and hash bucket. In each source the bucket in which
the running sum reaches the budget is refined by the next bits of the hash, until
the boundary is one hash value. A document is then taken if its hash lies below
its source's threshold: no sort, and the same result on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubestar.llm.common import WORD, bounded_broadcast
from cubestar.sources.workdir import stage

HASH_BITS = 60
LEVEL_BITS = 12
MAX_BROADCAST_SOURCES = 10_000
SEED = "mix"


def words_in(c) -> F.Column:
    """The number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(c, seed: str = SEED) -> F.Column:
    """60 bits of an md5 of the seed and the id; a null id is hashed as 'null'."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(c).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3
) -> DataFrame:
    """source, source_size, target: budgets that share the size of all rows.

    Sources by code point, null last, weigh ``weights``, repeating. A target
    stops at ``max_repeat`` times its source's size and the rest is shared anew
    by weight until none is above: with sources ordered by size per weight, the
    stopped ones are a prefix, so one pass of running sums finds them.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    weighed = weighed.withColumn("cap", F.col("source_size") * max_repeat)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    shared = weighed.withColumns(
        {
            "_left": F.sum("source_size").over(everything)
            - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "_weights": F.sum("weight").over(rest),
        }
    )
    # Stopped while the source's share of what is left exceeds its cap.
    stops = F.col("_left") * F.col("weight") > F.col("cap") * F.col("_weights")
    level = F.when(~stops, F.struct("_weights", "_left"))
    return shared.withColumns({"_stops": stops, "_level": F.max(level).over(everything)}).select(
        "source",
        "source_size",
        F.when(F.col("_stops"), F.col("cap").cast("double"))
        .otherwise(
            F.col("_level._left").cast("double") / F.col("_level._weights") * F.col("weight")
        )
        .alias("target"),
    )


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """The targets with ``repeats`` and ``threshold``.

    Every document is taken ``repeats`` times, and once more if its hash is
    below ``threshold``. ``sizes`` has source, size, hash and is read twice. The
    last hash value is taken where that comes nearer to the target; documents
    with equal ids share a hash and are taken together.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = targets.withColumn("repeats", whole.cast("long")).select(
        "*",
        (F.col("target") - F.col("repeats") * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("prefix"),
        F.lit(0).cast("long").alias("below"),
        F.lit(0).cast("long").alias("edge"),
    )
    state = stage(state, "mix-targets")
    n_sources = state.count()
    open_rows = sizes.select("source", "size", "hash").where("size > 0")
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        histogram = open_rows.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(
            F.sum("size").alias("bucket_size")
        )
        running = Window.partitionBy("source").orderBy("bucket")
        s, h = state.alias("s"), histogram.alias("h")
        reached = (
            h.join(
                bounded_broadcast(s, n_sources, MAX_BROADCAST_SOURCES),
                F.col("h.source").eqNullSafe(F.col("s.source")),
            )
            .select("h.source", "bucket", "bucket_size", "budget", "below")
            .withColumn("upto", F.col("below") + F.sum("bucket_size").over(running))
            .where("upto >= budget AND budget > 0")
            .groupBy("source")
            .agg(F.min(F.struct("bucket", "upto", "bucket_size")).alias("b"))
            .alias("r")
        )
        # A source without a budget takes no hash; one whose sum stays below it, all.
        state = s.join(reached, F.col("s.source").eqNullSafe(F.col("r.source")), "left").select(
            "s.source", "source_size", "target", "repeats", "budget",
            F.coalesce("b.bucket", F.when(F.col("budget") > 0, 1 << (HASH_BITS - shift)).otherwise(0)).alias("prefix"),
            F.coalesce(F.col("b.upto") - F.col("b.bucket_size"), "below").alias("below"),
            F.coalesce("b.bucket_size", F.lit(0).cast("long")).alias("edge"),
        )
        state = stage(state, "mix-level")
        if shift:
            s, o = state.alias("s"), open_rows.alias("o")
            open_rows = stage(
                o.join(
                    bounded_broadcast(s.select("source", "prefix"), n_sources, MAX_BROADCAST_SOURCES),
                    F.col("o.source").eqNullSafe(F.col("s.source"))
                    & (F.shiftright("o.hash", shift) == F.col("s.prefix")),
                ).select("o.source", "o.size", "o.hash"),
                "mix-edge",
            )
    nearer = (F.col("edge") > 0) & (
        F.col("below") + F.col("edge") - F.col("budget") <= F.col("budget") - F.col("below")
    )
    return state.select(
        "source", "source_size", "target", "repeats",
        (F.col("prefix") + nearer.cast("long")).alias("threshold"),
    )


def mix_plan(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    max_repeat: int = 3,
    seed: str = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """(sizes, plan): doc_id, source, size, hash of every row, read from storage,
    and the targets and thresholds of every source."""
    sizes = stage(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            words_in(F.col(text)).alias("size"),
            document_hash(doc_id, seed).alias("hash"),
        ),
        "mix-sizes",
    )
    return sizes, thresholds(sizes, source_targets(sizes, weights, max_repeat))


def with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` (0 to ``max_repeat``).

    ``rows`` has source and hash. A null source is a source of its own. Empty
    documents have no size and are taken like any other hash. Columns of the
    added names are replaced.
    """
    rows = rows.drop("source_size", "target", "copies")
    p = plan.select(
        F.col("source").alias("_source"), "source_size", "target", "repeats", "threshold"
    )
    joined = rows.join(
        bounded_broadcast(p, p.count(), MAX_BROADCAST_SOURCES),
        F.col("source").eqNullSafe(F.col("_source")),
        "left",
    )
    more = F.col("hash") < F.col("threshold")
    return joined.select(
        *[F.col(c) for c in rows.columns],
        "source_size",
        "target",
        (F.col("repeats") + more.cast("long")).alias("copies"),
    )


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """The mixture itself: each row of ``docs``, with all its columns, as often as it is taken.

    Null texts have no words; an empty table gives no rows.
    """
    _, plan = mix_plan(docs, weights, max_repeat)
    rows = docs.select(F.struct("*").alias("row"), "source", document_hash("doc_id").alias("hash"))
    times = F.array_repeat(F.lit(1), F.col("copies").cast("int"))
    return with_copies(rows, plan).select("row", F.explode(times)).select("row.*")
