"""Distinct dimension members, insert-if-absent and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubestar.functions.codes import (
    coerce,
    dimension_key,
    dimension_names,
    stripped_text,
    with_place_key,
)
from cubestar.operators.surrogates import MEMBER_KEY, PERIOD_KEY, PLACE_KEY, give_ids
from cubestar.schema import (
    DIMENSION_COLUMNS,
    DIMENSION_KEY,
    PERIOD_ATTRIBUTES,
    RAW_COLUMNS,
    STAR_SCHEMAS,
)
from cubestar.sources.metadata import catalogue_rows, period_rows, place_rows


def complete_raw(df: DataFrame) -> DataFrame:
    """Add the raw columns a source does not have, as NULL text."""
    missing = [c for c in RAW_COLUMNS if c not in df.columns]
    return df.selectExpr("*", *(f"CAST(NULL AS STRING) AS {c}" for c in missing))


def with_values(observations: DataFrame) -> DataFrame:
    """Rows without a value count for nothing, not even their codes."""
    return observations.filter(F.col("V").isNotNull())


# Columns that rank rows for "first row wins", as far as a source has them.
ORDER_COLUMNS = ("modificacao", "file_path", "pos")


def order_columns(df: DataFrame) -> list[str]:
    return [c for c in ORDER_COLUMNS if c in df.columns]


_DATE_STEP = 1 << 32


def compacted(df: DataFrame, columns: list[str], newest_first: bool) -> DataFrame:
    """Per file, one row for each combination of columns: the first or the last.

    Date and position make one number, so this is a hash aggregate that shrinks
    every input partition; the sort-based pick that follows sees few rows.
    """
    rank = F.lit(0).cast("bigint")
    if "modificacao" in df.columns:
        day = F.unix_date("modificacao").cast("bigint")
        rank = (-day if newest_first else day) * _DATE_STEP
    if "pos" in df.columns:
        rank = rank + F.col("pos")
    pick = F.min if newest_first else F.max
    files = [c for c in ("file_path",) if c in df.columns]
    best = df.groupBy(*columns, *files).agg(pick(rank).alias("rank"))
    # Date before file before position, as a sortable column.
    order = F.struct(
        F.shiftright("rank", 32).alias("day"),
        *files,
        F.pmod("rank", F.lit(_DATE_STEP)).alias("pos"),
    )
    return best.select(*columns, order.alias("seen_at"))


def _first(
    df: DataFrame, keys: list[str], values: list[str], order: list[str] | None = None
) -> DataFrame:
    """One row per key: newest modification, then file, then position.

    The value columns break ties, so reruns agree. The aggregate combines in
    each input partition first: a key that holds most rows sends one row per
    partition through the shuffle.
    """
    if order is None:
        df, order = compacted(df, [*keys, *values], newest_first=True), ["seen_at"]
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*order, *values)).alias("w"))
        .select(*keys, *(f"w.{v}" for v in values))
    )


def keyed_rows(observations: DataFrame) -> DataFrame:
    """Valued rows with place and member codes, names, period and value."""
    df = with_values(complete_raw(observations))
    carried = [c for c in ("tabela_sidra_id", *ORDER_COLUMNS) if c in df.columns]
    rows = df.selectExpr(
        *carried,
        "NC",
        f"{coerce('NN')} AS nn",
        "D1C",
        f"{coerce('D1N')} AS d1n",
        *dimension_key(),
        *dimension_names(),
        f"{coerce('D3C')} AS codigo",
        f"{coerce('V')} AS v",
    )
    return with_place_key(rows)


def places_of(rows: DataFrame) -> DataFrame:
    """D1 on keyed rows; names are stripped once per place."""
    first = _first(rows, ["nc", "d1c"], ["nn", "d1n"])
    return first.selectExpr(
        f"{PLACE_KEY} AS key",
        "nc",
        f"{stripped_text('nn')} AS nn",
        "d1c",
        f"{stripped_text('d1n')} AS d1n",
    )


def distinct_places(observations: DataFrame) -> DataFrame:
    """Places of the rows with a value, first row gives the names."""
    return places_of(keyed_rows(observations))


def dimensions_of(rows: DataFrame, keep_unmatchable: bool = False) -> DataFrame:
    """D2 on keyed rows."""
    if not keep_unmatchable:
        rows = rows.filter(F.col("d2c").isNotNull())
    values = [c for c in DIMENSION_COLUMNS if c not in DIMENSION_KEY]
    first = _first(rows, list(DIMENSION_KEY), values)
    filled = first.withColumn("d2c", F.coalesce("d2c", F.lit("")))
    return filled.selectExpr(f"{MEMBER_KEY} AS key", *DIMENSION_COLUMNS)


def distinct_dimensions(
    observations: DataFrame, keep_unmatchable: bool = False
) -> DataFrame:
    """Dimension members of the rows with a value, NULL codes equal.

    A member whose variable code is NULL can never be found again by a lookup;
    it is left out unless ``keep_unmatchable`` (then its code is empty).
    """
    return dimensions_of(keyed_rows(observations), keep_unmatchable)


def distinct_period_codes(
    observations: DataFrame, by: tuple[str, ...] = ()
) -> DataFrame:
    """D3: period codes of the rows with a value; NULL and empty left out."""
    return (
        with_values(observations)
        .selectExpr(*by, f"{coerce('D3C')} AS codigo")
        .filter(F.col("codigo") != "")
        .distinct()
    )


def insert_absent(existing: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """An existing row always wins; its names are never refreshed.

    Candidates carry their content key; those that are new get ids.
    """
    _, fresh = give_ids(existing, candidates, key)
    return existing.unionByName(fresh.select(*existing.columns))


def places_from_metadata(metadata: DataFrame) -> DataFrame:
    """Distinct places of all cubes, first cube and position give the names."""
    rows = place_rows(metadata)
    first = _first(
        rows, ["nc", "d1c"], ["nn", "d1n"], order=["tabela_sidra_id", "pos"]
    )
    return first.selectExpr(f"{PLACE_KEY} AS key", "nc", "nn", "d1c", "d1n")


def periods_from_metadata(metadata: DataFrame) -> DataFrame:
    """Distinct periods of all cubes; the last cube and position give the attributes."""
    rows = period_rows(metadata).withColumn("key", F.expr(PERIOD_KEY))
    attributes = ["codigo", "literals", *PERIOD_ATTRIBUTES]
    last = rows.groupBy("key").agg(
        F.max(F.struct("tabela_sidra_id", "pos", *attributes)).alias("w")
    )
    return last.select("key", *(f"w.{a}" for a in attributes))


def upsert_periods(existing: DataFrame, candidates: DataFrame) -> DataFrame:
    """On an equal (code, literals) key all attributes but the id are replaced."""
    ids, _ = give_ids(existing, candidates, PERIOD_KEY)
    written = candidates.join(ids, "key").select(*STAR_SCHEMAS["periodo"].fieldNames())
    return existing.join(written.select("id"), "id", "left_anti").unionByName(written)


def upsert_catalogue(
    existing: DataFrame, metadata: DataFrame, load_date: Column | None = None
) -> DataFrame:
    """On an equal id only the description is replaced."""
    today = F.current_date() if load_date is None else load_date
    described = ("nome", "periodicidade", "metadados")
    # A cube described twice counts once.
    new = (
        catalogue_rows(metadata)
        .groupBy("id")
        .agg(F.min(F.struct(*described)).alias("d"))
        .select("id", *(F.col(f"d.{c}").alias(f"new_{c}") for c in described))
    )
    joined = existing.withColumn("known", F.lit(True)).join(new, "id", "full_outer")
    known = F.col("known").isNotNull()
    return joined.select(
        "id",
        F.when(known, F.col("nome")).otherwise(F.col("new_nome")).alias("nome"),
        F.when(known, F.col("periodicidade"))
        .otherwise(F.col("new_periodicidade"))
        .alias("periodicidade"),
        F.when(known, F.col("ultima_atualizacao"))
        .otherwise(today)
        .alias("ultima_atualizacao"),
        F.coalesce("new_metadados", "metadados").alias("metadados"),
    )


def unique_tables(rows: DataFrame, key: str = "tabela_sidra") -> DataFrame:
    """Each cube id once; the order of the list plays no part afterwards."""
    return rows.dropDuplicates([key])
