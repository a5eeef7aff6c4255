"""Dense long ids of members, given once and kept over loads.

A member is told by its content key; the id is what facts carry. Only keys that a
table does not hold yet get an id, above the highest one there. Candidates are
written first with the place that each has in its partition. New ones are numbered
within their partition, and the running sum of the partitions' counts, one row per
partition, moves each behind the ones before it: no task sees more than one
partition of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubestar.functions.codes import content_key, period_key
from cubestar.schema import DIMENSION_KEY, MEMBER_TABLES, Star
from cubestar.sources.workdir import broadcast_if_small, staged

PLACE_KEY = content_key("nc", "d1c")
MEMBER_KEY = content_key(*DIMENSION_KEY)
PERIOD_KEY = period_key("codigo", "literals")

#: Content keys of the tables whose rows carry ids.
KEYS = {"localidade": PLACE_KEY, "dimensao": MEMBER_KEY, "periodo": PERIOD_KEY}

#: Ids that are broadcast with their content keys, and with hashes of these.
MAX_KEYS = 200_000
MAX_HASHES = 1_000_000

#: ``monotonically_increasing_id`` has the partition's number above these bits.
_PLACE_BITS = 33


def placed(rows: DataFrame) -> DataFrame:
    """The rows with their place (partition and row) as ``_at``; to be written next."""
    return rows.withColumn("_at", F.monotonically_increasing_id())


def dense_ids(written: DataFrame, after: int = 0) -> DataFrame:
    """Rows with an id each: after + 1, after + 2 and so on, without gaps.

    ``written`` is a stored table with the places of ``placed``, or some of its rows.
    """
    part = F.shiftright("_at", _PLACE_BITS).alias("_part")
    rows = written.withColumn("_part", part)
    within = Window.partitionBy("_part").orderBy("_at")
    # One row per partition of the write, however many rows there are.
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    numbered = rows.withColumn("_row", F.row_number().over(within))
    return numbered.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_row") + F.lit(after)).alias("id"),
        *(c for c in written.columns if c != "_at"),
    )


def highest_id(table: DataFrame) -> int:
    return table.agg(F.max("id")).first()[0] or 0


def give_ids(existing: DataFrame, candidates: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(key and id of every candidate, rows that are new with their ids).

    ``candidates`` has one row per ``key`` column; ``key`` is the expression of the
    same key over ``existing``, whose ids stay as they are.
    """
    known = existing.selectExpr(f"{key} AS key", "id")
    found = staged(placed(candidates.join(known, "key", "left")), "candidates")
    fresh = dense_ids(found.where("id IS NULL").drop("id"), highest_id(existing))
    ids = found.where("id IS NOT NULL").select("key", "id").unionByName(fresh.select("key", "id"))
    return ids, fresh.drop("key")


def with_member_ids(cells: DataFrame, places: DataFrame, members: DataFrame) -> DataFrame:
    """Cells with ids in place of the content keys of place and member.

    ``places`` and ``members`` hold key and id of at least the cells' keys; the sides
    are broadcast only if a count shows them small. Many ids are joined by a hash of
    eight bytes in place of the key, if it tells all keys apart, and then the cells
    are written, so that a later shuffle does not add to that of the join.
    """
    for ids, name in ((places, "localidade"), (members, "dimensao")):
        key, told = f"{name}_key", f"{name}_id"
        if ids.limit(MAX_KEYS + 1).count() <= MAX_KEYS:
            renamed = ids.select(F.col("key").alias(key), F.col("id").alias(told))
            cells = cells.join(F.broadcast(renamed), key).drop(key)
            continue
        hashed = staged(ids.select(F.xxhash64("key").alias("_hash"), F.col("key").alias(key), F.col("id").alias(told)), "ids")
        n, different = hashed.agg(F.count(F.lit(1)), F.count_distinct("_hash")).first()
        by, mine = ("_hash", hashed.drop(key)) if n == different else (key, hashed.drop("_hash"))
        cells = cells.where(F.col(key).isNotNull()).withColumn("_hash", F.xxhash64(key))
        cells = cells.drop(key if by == "_hash" else "_hash")
        small = by == "_hash" and n <= MAX_HASHES
        cells = cells.join(F.broadcast(mine) if small else mine, by).drop(by)
        if not small:
            cells = staged(cells, "cells")
    return cells


def with_content_keys(star: Star, rows: DataFrame) -> DataFrame:
    """Rows with content keys in place of ids, for comparing stars that grew apart.

    An id that its table does not hold becomes NULL.
    """
    columns = rows.columns
    for table in MEMBER_TABLES:
        column = f"{table}_id"
        if column in columns and getattr(star, table) is not None:
            keys = getattr(star, table).selectExpr(f"id AS {column}", f"{KEYS[table]} AS _key")
            rows = rows.join(keys, column, "left").drop(column).withColumnRenamed("_key", column)
    return rows.select(*columns)
