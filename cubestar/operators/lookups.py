"""Lookups from codes to ids and the resolution of raw cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubestar.functions.codes import coerce
from cubestar.operators.dimensions import (
    keyed_rows,
    order_columns,
    with_values,
)
from cubestar.operators.surrogates import MEMBER_KEY, PERIOD_KEY, PLACE_KEY
from cubestar.schema import DIMENSION_COLUMNS, DIMENSION_KEY
from cubestar.sources.workdir import broadcast_if_small

#: Cubes up to this number are broadcast with their periodicities, two short texts each.
MAX_CUBES = 1_000_000

# Why a cell was not accepted, in the order the checks are made.
REJECT_REASONS = ("localidade", "dimensao", "periodo")


def place_lookup(localidade: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """(nc, d1c) to id, restricted to the given keys if there are any."""
    lookup = localidade.select("nc", "d1c", F.col("id").alias("localidade_id"))
    if keys is None:
        return lookup
    return lookup.join(keys.select("nc", "d1c"), ["nc", "d1c"], "left_semi")


def dimension_lookup(dimensao: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Eight codes to id; the restriction looks at the variable code only."""
    lookup = dimensao.select(*DIMENSION_KEY, F.col("id").alias("dimensao_id"))
    if keys is None:
        return lookup
    return lookup.join(keys.select("d2c"), "d2c", "left_semi").select(
        *DIMENSION_KEY, "dimensao_id"
    )


def period_lookup(periodo: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """(code, literals) to id; missing literals look like an empty list."""
    lookup = periodo.select(
        "codigo",
        F.coalesce("literals", F.array().cast("array<string>")).alias("literals"),
        F.col("id").alias("periodo_id"),
    )
    if keys is None:
        return lookup
    return lookup.join(keys.select("codigo"), "codigo", "left_semi")


def period_by_code(
    periodo: DataFrame,
    frequencies: DataFrame | None = None,
    codes: DataFrame | None = None,
) -> DataFrame:
    """One id per code among the allowed frequencies, with the hit count.

    No frequencies means no filter. Several hits resolve to the smallest content key,
    so that the order in which periods were stored plays no part.
    """
    rows = periodo.select("codigo", "frequencia", "id", F.expr(PERIOD_KEY).alias("key"))
    if frequencies is not None:
        rows = rows.join(
            frequencies.select("frequencia"), "frequencia", "left_semi"
        )
    if codes is not None:
        rows = rows.join(codes.select("codigo"), "codigo", "left_semi")
    return rows.groupBy("codigo").agg(
        F.min_by("id", "key").alias("periodo_id"), F.count(F.lit(1)).alias("hits")
    )


def table_periodicity(tabela_sidra: DataFrame) -> DataFrame:
    """The periodicity of every cube, joined on instead of probed one by one."""
    return tabela_sidra.select(
        F.col("id").alias("tabela_sidra_id"), "periodicidade"
    )


def period_by_group(
    periodo: DataFrame, frequencies: DataFrame | None = None
) -> DataFrame:
    """J4 for all cubes at once: (frequency group, code) to id.

    The group is a periodicity with its allowed frequencies, or the empty text
    where every frequency is allowed. ``frequencies`` lists (periodicidade,
    frequencia) pairs; by default a periodicity allows the equal frequency.
    """
    codes = periodo.select("codigo", "frequencia", "id", F.expr(PERIOD_KEY).alias("key"))
    if frequencies is None:
        grouped = codes.filter("frequencia <> ''").withColumn(
            "grupo", F.col("frequencia")
        )
    else:
        pairs = frequencies.select(
            F.col("periodicidade").alias("grupo"), "frequencia"
        ).distinct()
        grouped = codes.join(pairs, "frequencia")
    every = codes.withColumn("grupo", F.lit(""))
    return (
        grouped.select("grupo", "codigo", "id", "key")
        .union(every.select("grupo", "codigo", "id", "key"))
        .groupBy("grupo", "codigo")
        .agg(F.min_by("id", "key").alias("periodo_id"), F.count(F.lit(1)).alias("hits"))
    )


def table_group(
    tabela_sidra: DataFrame, frequencies: DataFrame | None = None
) -> DataFrame:
    """J8 with J4: the frequency group of every cube of the catalogue."""
    tables = table_periodicity(tabela_sidra)
    if frequencies is None:
        return tables.withColumnRenamed("periodicidade", "grupo")
    listed = frequencies.select(
        "periodicidade", F.col("periodicidade").alias("grupo")
    ).distinct()
    return tables.join(listed, "periodicidade", "left").select(
        "tabela_sidra_id", "grupo"
    )


def period_match_ratio(
    observations: DataFrame,
    periodo: DataFrame,
    tabela_sidra: DataFrame,
    frequencies: DataFrame | None = None,
) -> DataFrame:
    """A5: per cube, distinct period codes in the data and how many resolve."""
    codes = (
        with_values(observations)
        .selectExpr("tabela_sidra_id", f"{coerce('D3C')} AS codigo")
        .filter("codigo <> ''")
        .distinct()
    )
    resolved = _with_period_id(codes, periodo, tabela_sidra, frequencies)
    return resolved.groupBy("tabela_sidra_id").agg(
        F.count(F.lit(1)).alias("codes"),
        F.count("periodo_id").alias("matched"),
    )


def _with_period_id(df, periodo, tabela_sidra, frequencies):
    # One row per cube, and one or two per period unless frequencies are given.
    groups = table_group(tabela_sidra, frequencies)
    if tabela_sidra.count() > MAX_CUBES:
        # Few of the cubes are in a batch: a shuffle by cube would deal all its rows to them.
        groups = groups.join(df.select("tabela_sidra_id").distinct(), "tabela_sidra_id", "left_semi")
        groups = broadcast_if_small(groups, MAX_CUBES)
    else:
        groups = F.broadcast(groups)
    by_code = period_by_group(periodo, frequencies).select(
        "grupo", "codigo", "periodo_id", F.col("hits").alias("period_hits")
    )
    if frequencies is None:
        by_code = broadcast_if_small(by_code, 100_000, count_of=periodo)
    else:
        by_code = broadcast_if_small(by_code)
    return (
        df.join(groups, "tabela_sidra_id", "left")
        .withColumn("grupo", F.coalesce("grupo", F.lit("")))
        .join(by_code, ["grupo", "codigo"], "left")
        .drop("grupo")
    )


# What tells place and member of a resolved cell: ids, or content keys before ids exist.
BY_ID = ("localidade_id", "dimensao_id")
BY_KEY = ("localidade_key", "dimensao_key")


def resolve_cells(
    observations: DataFrame,
    localidade: DataFrame,
    dimensao: DataFrame,
    periodo: DataFrame,
    tabela_sidra: DataFrame,
    frequencies: DataFrame | None = None,
) -> DataFrame:
    """Ids of every cell against given dimensions, or its first failure.

    Accepted cells have no ``reject_reason`` and are active.
    """
    cells = keyed_rows(observations)
    cells = cells.join(place_lookup(localidade), ["nc", "d1c"], "left")
    dims = dimension_lookup(dimensao).filter(F.col("d2c").isNotNull())
    renamed = dims.select(*(F.col(c).alias(f"k_{c}") for c in DIMENSION_KEY), "dimensao_id")
    same = F.expr(" AND ".join(f"{c} <=> k_{c}" for c in DIMENSION_KEY))
    cells = cells.join(renamed, same, "left").drop(
        *(f"k_{c}" for c in DIMENSION_KEY)
    )
    cells = _with_period_id(cells, periodo, tabela_sidra, frequencies)
    return _resolved(cells, BY_ID)


def resolve_by_content(
    observations: DataFrame,
    periodo: DataFrame,
    tabela_sidra: DataFrame,
    frequencies: DataFrame | None = None,
    keep_names: bool = False,
) -> DataFrame:
    """J5 inside a load, which inserts the batch's own members.

    Place and member are told by their content keys, so this needs no join with
    them: the only member a lookup would miss is one with a NULL variable code.
    Ids are joined on once the new members have theirs. ``keep_names`` keeps the
    codes and names of the members next to the keys.
    """
    cells = keyed_rows(observations).selectExpr(
        "*",
        f"{PLACE_KEY} AS localidade_key",
        f"CASE WHEN d2c IS NOT NULL THEN {MEMBER_KEY} END AS dimensao_key",
    )
    names = ["nc", "nn", "d1c", "d1n", *DIMENSION_COLUMNS] if keep_names else []
    return _resolved(
        _with_period_id(cells, periodo, tabela_sidra, frequencies), BY_KEY, names
    )


def _resolved(cells: DataFrame, told_by: tuple[str, str], names: list[str] | None = None) -> DataFrame:
    # A cell without a modification date cannot be ranked; it is counted, not lost.
    dated = "modificacao" in cells.columns
    undated = " WHEN modificacao IS NULL THEN 'modificacao'" if dated else ""
    checks = zip((*told_by, "periodo_id"), REJECT_REASONS)
    first_failure = " ".join(f"WHEN {column} IS NULL THEN '{name}'" for column, name in checks)
    return cells.selectExpr(
        "tabela_sidra_id",
        *told_by,
        "periodo_id",
        "period_hits",
        "codigo",
        *order_columns(cells),
        "true AS ativo",
        "v",
        f"CASE {first_failure}{undated} END AS reject_reason",
        *(names or []),
    )
