"""Fact merge: insert-if-absent cells, deactivate superseded ones, report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubestar.functions.codes import content_key
from cubestar.schema import CELL_KEY, FACT_COLUMNS, FACT_PARTITIONS
from cubestar.sources.workdir import broadcast_if_small, staged

# How a newer modification of a stored cell is treated.
#   latest      it is stored next to the old one, which becomes inactive
#   keep_first  it is not stored; the old one becomes inactive all the same
REVISIONS = ("latest", "keep_first")

#: Cubes of a batch up to this number are listed in the filter on stored facts.
MAX_LISTED_CUBES = 10_000


def _check(revisions: str) -> None:
    if revisions not in REVISIONS:
        raise ValueError(f"revisions must be one of {REVISIONS}, not {revisions!r}")


def accepted(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.col("reject_reason").isNull())


def rejected(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.col("reject_reason").isNotNull())


def latest_modification(cells: DataFrame) -> DataFrame:
    """A1: greatest modification per (cube, period) of a batch."""
    return cells.groupBy(*FACT_PARTITIONS).agg(
        F.max("modificacao").alias("max_modificacao")
    )


def batch_cells(cells: DataFrame, revisions: str = "latest") -> DataFrame:
    """D7, inside the batch: one row per key.

    Order of preference: newest modification, then file, position and value.
    """
    _check(revisions)
    order = [F.col(c) for c in ("file_path", "pos") if c in cells.columns]
    keys = [*CELL_KEY]
    if revisions == "latest":
        # The rows of a key have one modification.
        keys.append("modificacao")
        first = F.min(F.struct(*order, "v"))
    else:
        first = F.min(F.struct((-F.unix_date("modificacao")).alias("o1"), *order, "v", "modificacao"))
    picked = cells.groupBy(*keys).agg(first.alias("w"))
    # As a grouping key the date keeps the partitioning the anti join needs.
    date = F.col("modificacao" if revisions == "latest" else "w.modificacao")
    return picked.select(
        *CELL_KEY,
        date.alias("modificacao"),
        F.lit(True).alias("ativo"),
        F.col("w.v").alias("v"),
    ).select(*FACT_COLUMNS)


def new_cells(
    stored: DataFrame, cells: DataFrame, revisions: str = "latest"
) -> DataFrame:
    """Batch cells whose key is not stored yet."""
    keys = [*CELL_KEY, "modificacao"] if revisions == "latest" else [*CELL_KEY]
    return batch_cells(cells, revisions).join(
        stored.select(*keys), keys, "left_anti"
    )


def deactivate_superseded(facts: DataFrame, latest: DataFrame) -> DataFrame:
    """A2: active facts older than the newest modification of their (cube, period)."""
    latest = broadcast_if_small(staged(latest, "latest"))
    joined = facts.join(latest, list(FACT_PARTITIONS), "left")
    older = F.coalesce(F.col("modificacao") < F.col("max_modificacao"), F.lit(False))
    return joined.withColumn("ativo", F.col("ativo") & ~older).select(*facts.columns)


def touched_partitions(cells: DataFrame) -> DataFrame:
    """A1 of a batch, written once: one row per (cube, period) it touches.

    It is counted before it is broadcast.
    """
    return broadcast_if_small(staged(latest_modification(cells), "touched"))


def of_cubes(stored: DataFrame, touched: DataFrame, max_cubes: int = MAX_LISTED_CUBES) -> DataFrame:
    """Stored facts of the cubes of a batch, as a filter on the partition column.

    The cubes of a batch are few however many pairs it touches, so other cubes
    are pruned while planning, with or without broadcasts. A batch of more than
    ``max_cubes`` cubes reads all.
    """
    cube = FACT_PARTITIONS[0]
    cubes = [r[0] for r in touched.select(cube).distinct().limit(max_cubes + 1).collect()]
    return stored if len(cubes) > max_cubes else stored.filter(F.col(cube).isin(cubes))


def merge_touched(
    stored: DataFrame,
    cells: DataFrame,
    revisions: str = "latest",
    latest: DataFrame | None = None,
) -> DataFrame:
    """New content of every (cube, period) the batch touches.

    Adds ``inserted`` and ``deactivated`` flags to the fact columns. Partitions
    the batch does not mention are not read: the (cube, period) pairs of the
    batch are the partition columns of the stored facts.
    """
    _check(revisions)
    if latest is None:
        latest = touched_partitions(cells)
    touched = of_cubes(stored, latest).join(latest, list(FACT_PARTITIONS)).select(
        *FACT_COLUMNS, F.lit(False).alias("inserted")
    )
    added = new_cells(touched, cells, revisions)
    newest = latest
    if revisions == "latest":
        # A batch may bring an older revision than the one stored. The stored
        # side has no other pairs than the batch, so this is as small.
        newest = broadcast_if_small(
            latest.unionByName(latest_modification(touched))
            .groupBy(*FACT_PARTITIONS)
            .agg(F.max("max_modificacao").alias("max_modificacao")),
            count_of=latest,
        )
    everything = touched.unionByName(
        added.withColumn("inserted", F.lit(True))
    )
    older = F.col("modificacao") < F.col("max_modificacao")
    return everything.join(newest, list(FACT_PARTITIONS)).select(
        *(c for c in FACT_COLUMNS if c not in ("ativo", *FACT_PARTITIONS)),
        (F.col("ativo") & ~older).alias("ativo"),
        *FACT_PARTITIONS,
        "inserted",
        (F.col("ativo") & older).alias("deactivated"),
    )


def untouched(stored: DataFrame, latest: DataFrame) -> DataFrame:
    return stored.join(
        latest.select(*FACT_PARTITIONS), list(FACT_PARTITIONS), "left_anti"
    )


def load_report(resolved: DataFrame, merged: DataFrame) -> DataFrame:
    """A3: per cube, what was staged, stored, switched off and left out.

    ``ambiguous_periods`` counts the staged cells whose period code has several
    periods of the allowed frequencies, of which one was taken.
    """
    reason = F.col("reject_reason")
    read = resolved.groupBy("tabela_sidra_id").agg(
        F.count_if(reason.isNull()).alias("staged"),
        F.count_if(reason == "localidade").alias("missing_places"),
        F.count_if(reason == "dimensao").alias("missing_dimensions"),
        F.count_if(reason == "periodo").alias("missing_periods"),
        F.count_if(reason == "modificacao").alias("missing_modifications"),
        F.count_if(reason.isNull() & (F.col("period_hits") > 1)).alias("ambiguous_periods"),
    )
    written = merged.groupBy("tabela_sidra_id").agg(
        F.count_if("inserted").alias("inserted"),
        F.count_if("deactivated").alias("deactivated"),
    )
    return read.join(written, "tabela_sidra_id", "left").select(
        "tabela_sidra_id",
        "staged",
        F.coalesce("inserted", F.lit(0)).alias("inserted"),
        F.coalesce("deactivated", F.lit(0)).alias("deactivated"),
        "missing_places",
        "missing_dimensions",
        "missing_periods",
        "missing_modifications",
        "ambiguous_periods",
    )


def with_fact_id(facts: DataFrame) -> DataFrame:
    """D8 for facts: computed when asked for instead of stored per row.

    Ids of members are kept over loads, so this is as well.
    """
    key = (*CELL_KEY, "CAST(modificacao AS STRING)")
    return facts.withColumn("id", F.expr(content_key(*key)))
