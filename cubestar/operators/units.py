"""Unit codes of dimension members, taken from observed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubestar.functions.codes import coerce, strip
from cubestar.operators.dimensions import (
    compacted,
    complete_raw,
    order_columns,
)
from cubestar.schema import SLOT_CODES
from cubestar.sources.workdir import broadcast_if_small, staged

# A NULL member code is matched as this text.
NULL_TEXT = "None"


def _member(c: str) -> str:
    return f"coalesce({coerce(c)}, '{NULL_TEXT}') AS k_{c.lower()}"


def enrich_units(members: DataFrame, observations: DataFrame) -> DataFrame:
    """Fill ``mc`` by variable and categories, else by unit name, else keep it.

    The last observed row of a key wins, in file and position order. Rows
    without a value count here too.
    """
    codes = ["D2C", *SLOT_CODES]
    raw = complete_raw(observations).filter(F.col("MC").isNotNull())
    seen = raw.selectExpr(
        "tabela_sidra_id",
        *order_columns(raw),
        *(_member(c) for c in codes),
        f"{strip(coerce('MC'))} AS seen_mc",
        f"{strip(coerce('MN'))} AS seen_mn",
    )
    last = F.max(F.struct("seen_at", "seen_mc"))["seen_mc"]
    keys = [f"k_{c.lower()}" for c in codes]
    columns = ["tabela_sidra_id", *keys, "seen_mc", "seen_mn"]
    seen = compacted(seen, columns, newest_first=False)
    by_combo = seen.groupBy("tabela_sidra_id", *keys).agg(last.alias("combo_mc"))
    by_name = (
        seen.filter("seen_mn <> '' AND seen_mc <> ''")
        .groupBy("tabela_sidra_id", "seen_mn")
        .agg(last.alias("name_mc"))
    )
    # One cube and unit may hold most members, so the few names are written
    # and broadcast after a count instead of shuffling members by name.
    by_name = broadcast_if_small(staged(by_name, "unit-names"))
    keyed = members.selectExpr("*", *(_member(c.lower()) for c in codes))
    return (
        keyed.join(by_combo, ["tabela_sidra_id", *keys], "left")
        .join(
            by_name.withColumnRenamed("seen_mn", "mn"),
            ["tabela_sidra_id", "mn"],
            "left",
        )
        .withColumn("mc", F.coalesce("combo_mc", "name_mc", "mc"))
        .select(*members.columns)
    )
