"""Q3 for several indexes: rows along one curve through all of their columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of a column, as a power of two; a curve interleaves this many bits of each.
BITS = 6
#: Rows that the ends of the ranges are taken from, whatever the table holds.
SAMPLE_ROWS = 50_000


def range_ends(df: DataFrame, column: str, bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> list:
    """Ends of at most 2 ** bits ranges of about equally many rows each.

    They steer the layout only, so a sample does; its size is bounded.
    """
    values = df.select(F.col(f"`{column}`").alias("v")).where("v IS NOT NULL")
    n = values.count()
    if n > sample_rows:
        values = values.sample(min(1.0, 1.2 * sample_rows / n), seed=7).limit(sample_rows)
    tiles = values.select("v", F.ntile(1 << bits).over(Window.orderBy("v")).alias("tile"))
    ends = [r.v for r in tiles.groupBy("tile").agg(F.max("v").alias("v")).orderBy("tile").collect()]
    return list(dict.fromkeys(ends[:-1]))


def _range_of(column: Column, ends: list, base: int = 0) -> Column:
    """Number of the range a value lies in, by halves; null lies in the first."""
    if not ends:
        return F.lit(base)
    half = len(ends) // 2
    above = _range_of(column, ends[half + 1 :], base + half + 1)
    below = _range_of(column, ends[:half], base)
    return F.when(column > F.lit(ends[half]), above).otherwise(below)


def z_order(df: DataFrame, columns: list[str], bits: int = BITS) -> Column:
    """Place of a row on the curve: the bits of its ranges in all columns, interleaved."""
    ranks = [_range_of(F.col(f"`{c}`"), range_ends(df, c, bits)) for c in columns]
    place = F.lit(0).cast("long")
    for bit in range(bits):
        for at, rank in enumerate(ranks):
            held = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long")
            place = place + F.shiftleft(held, bit * len(ranks) + at)
    return place
