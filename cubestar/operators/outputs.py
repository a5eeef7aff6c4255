"""Analytic queries over the star: flat tables, rollups, profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubestar.functions.codes import numeric_value, value_flag
from cubestar.schema import Star


SUMMARY_KEYS = ("tabela", "ano", "nivel", "localidade_id", "variavel", "unidade", "categoria")


def join_star(star: Star, tables: list[str] | None = None) -> DataFrame:
    """Active facts of the given cubes with their dimensions.

    The cube filter is on a partition column. Dimension sides are left to the
    optimizer: below the broadcast threshold their measured size makes them
    broadcast, above it the join shuffles and AQE splits a hot place or member.
    """
    facts = star.dados.filter("ativo")
    if tables is not None:
        facts = facts.filter(F.col("tabela_sidra_id").isin(list(tables)))
    d = facts.alias("d")
    return (
        d.join(star.periodo.alias("p"), F.col("d.periodo_id") == F.col("p.id"))
        .join(star.dimensao.alias("dim"), F.col("d.dimensao_id") == F.col("dim.id"))
        .join(star.localidade.alias("l"), F.col("d.localidade_id") == F.col("l.id"))
    )


def flatten(
    star: Star,
    tables: list[str] | None,
    columns: dict[str, str],
    strict: bool = False,
) -> DataFrame:
    """Chosen dimension columns and the numeric value of each active cell.

    ``columns`` maps output names to star columns such as ``p.ano`` or
    ``dim.d4n``.
    """
    return join_star(star, tables).select(
        *(F.col(source).alias(name) for name, source in columns.items()),
        F.expr(numeric_value("d.v", strict)).alias("valor"),
    )


def ordered(df: DataFrame, *keys: str | Column) -> DataFrame:
    """The whole result in order."""
    return df.orderBy(*keys)


def in_order(outputs: dict[str, DataFrame]) -> list[tuple[str, DataFrame]]:
    """U4: children by name, whatever order they are given in."""
    return sorted(outputs.items())


def union_outputs(outputs: dict[str, DataFrame], ordinal: bool = False) -> DataFrame:
    """Rows of several outputs below each other, with their name.

    ``ordinal`` adds the child's place in the order of names, from 1.
    """
    parts = []
    for at, (name, df) in enumerate(in_order(outputs), 1):
        named = df.withColumn("source", F.lit(name))
        parts.append(named.withColumn("ordinal", F.lit(at)) if ordinal else named)
    return reduce(DataFrame.unionByName, parts)


def annual_summary(
    flat: DataFrame, keys: tuple[str, ...] = SUMMARY_KEYS
) -> DataFrame:
    """Count, sum, mean and extremes of the values per year and member.

    A place code is unique within its level only, a cube publishes its own
    values, and values of different units do not add up: all three are keys.
    """
    return flat.groupBy(*keys).agg(
        F.count("valor").alias("n"),
        F.sum("valor").cast("decimal(38,10)").alias("soma"),
        F.try_divide(F.sum("valor").cast("double"), F.count("valor")).alias("media"),
        F.min("valor").alias("minimo"),
        F.max("valor").alias("maximo"),
    )


def flag_profile(facts: DataFrame, value: str = "v") -> DataFrame:
    """P10: how many values of each cube are numbers or one of the flags."""
    return facts.groupBy("tabela_sidra_id", F.expr(value_flag(value)).alias("flag")).agg(
        F.count(F.lit(1)).alias("n")
    )


def point_lookup(
    flat: DataFrame, place: str, order: str = "periodo", level: str | None = None
) -> DataFrame:
    """Rows of one place of a flat table, newest first.

    With ``level`` the flat table's ``nivel`` must agree as well; a table that
    holds places of several levels needs it.
    """
    rows = flat.filter(F.col("localidade_id") == place)
    if level is not None:
        rows = rows.filter(F.col("nivel") == level)
    return rows.orderBy(F.col(order).desc())
