"""Constraints as checks that return the rows breaking them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubestar.schema import FOREIGN_KEYS, PERIOD_RANGES, REQUIRED, UNIQUE, Star


def primary_key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q1: keys that hold a NULL or occur more than once."""
    has_null = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn(
        "violation",
        F.when(has_null, F.lit("null")).when(F.col("n_rows") > 1, F.lit("duplicate")),
    ).filter(F.col("violation").isNotNull())


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q2: keys without NULL that occur more than once."""
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
    )


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Q6: keys that occur more than once, NULLs equal."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
    )


def star_duplicates(star: Star, revisions: str = "latest") -> dict[str, DataFrame]:
    """Q6 for every table; revisions of a cell count as different keys."""
    found = {}
    for name, keys in UNIQUE.items():
        if name == "dados" and revisions == "latest":
            keys = (*keys, "modificacao")
        found[name] = duplicate_keys(getattr(star, name), keys)
    return found


def orphan_facts(star: Star) -> DataFrame:
    """Q4: per foreign key, ids without a dimension row and how many facts use them.

    The facts are scanned once: grouping sets count the uses of every id of every
    key, and one anti join meets the ids of all dimension tables. Ids come out as text.
    """
    columns = [F.col(c) for c in FOREIGN_KEYS]
    used = star.dados.groupingSets([[c] for c in columns], *columns).agg(
        F.grouping_id().alias("set"), F.count(F.lit(1)).alias("n_facts")
    )
    # The bit of a key is 0 in its own set, the first key's bit is the highest.
    n = len(FOREIGN_KEYS)
    whole = (1 << n) - 1
    name, value = F, F
    for at, column in enumerate(FOREIGN_KEYS):
        own = F.col("set") == whole - (1 << (n - 1 - at))
        name = name.when(own, F.lit(column))
        value = value.when(own, F.col(column).cast("string"))
    counted = used.select(name.alias("foreign_key"), value.alias("id"), "n_facts")
    known = reduce(
        DataFrame.unionByName,
        (
            getattr(star, table).select(F.lit(column).alias("foreign_key"), F.col("id").cast("string").alias("id"))
            for column, table in FOREIGN_KEYS.items()
        ),
    )
    return counted.join(known, ["foreign_key", "id"], "left_anti")


def range_violations(periodo: DataFrame) -> DataFrame:
    """Q5: periods with a semester, quarter or month out of range; NULL passes."""
    outside = [
        F.when(
            ~F.col(c).between(low, high), F.lit(c)
        )
        for c, (low, high) in PERIOD_RANGES.items()
    ]
    return periodo.withColumn("outside", F.concat_ws(",", *outside)).filter(
        "outside <> ''"
    )


def missing_values(df: DataFrame, required) -> DataFrame:
    """Q7: rows with a NULL in a required column, and which columns."""
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    return df.withColumn("missing", F.concat_ws(",", *missing)).filter(
        "missing <> ''"
    )


def star_missing(star: Star) -> dict[str, DataFrame]:
    return {
        name: missing_values(getattr(star, name), columns)
        for name, columns in REQUIRED.items()
    }
