"""The documented flat outputs as column choices over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubestar.operators.outputs import flatten, join_star, ordered
from cubestar.schema import Star

# Output columns of the documented queries.
STANDARD_COLUMNS = {
    "periodo": "p.codigo",
    "ano": "p.ano",
    "mes": "p.mes",
    "localidade_id": "l.d1c",
    "localidade": "l.d1n",
    "variavel": "dim.d2n",
    "categoria": "dim.d4n",
}
# The standard output with what makes a value comparable: cube, level and unit.
SUMMARY_COLUMNS = {
    "tabela": "d.tabela_sidra_id",
    **STANDARD_COLUMNS,
    "nivel": "l.nc",
    "unidade": "dim.mn",
}
MUNICIPAL_GDP_COLUMNS = {
    "ano": "p.ano",
    "id_municipio": "l.d1c",
    "municipio": "l.d1n",
    "nivel_id": "l.nc",
    "nivel": "l.nn",
    "variavel": "dim.d2n",
    "unidade": "dim.mn",
    "categoria": "dim.d4n",
}
PRICE_INDEX_COLUMNS = {
    "periodo": "p.codigo",
    "ano": "p.ano",
    "mes": "p.mes",
    "nivel_territorial_id": "l.nc",
    "nivel_territorial": "l.nn",
    "localidade_id": "l.d1c",
    "localidade": "l.d1n",
    "variavel": "dim.d2n",
    "categoria": "dim.d4n",
}
CROP_COLUMNS = {
    "ano": "p.ano",
    "id_municipio": "l.d1c",
    "municipio": "l.d1n",
    "produto": "dim.d4n",
    "variavel": "dim.d2n",
    "unidade": "dim.mn",
}
SERIES_COLUMNS = {
    "ano": "p.ano",
    "mes": "p.mes",
    "localidade": "l.d1n",
    "variavel": "dim.d2n",
    "categoria": "dim.d4n",
}
MUNICIPAL_GDP_TABLES = ["5938"]
PRICE_INDEX_TABLES = ["58", "61", "655", "656", "2938", "1419", "7060"]
CROP_TABLES = ["1613"]


def flat_output(star: Star, tables: list[str]) -> DataFrame:
    """The standard flat output."""
    return flatten(star, tables, STANDARD_COLUMNS)


def municipal_gdp(star: Star, tables: list[str] | None = None) -> DataFrame:
    """T4."""
    flat = flatten(star, tables or MUNICIPAL_GDP_TABLES, MUNICIPAL_GDP_COLUMNS)
    return ordered(flat, "ano", "id_municipio")


def price_index_history(star: Star, tables: list[str] | None = None) -> DataFrame:
    """One history stitched from several cubes."""
    flat = flatten(star, tables or PRICE_INDEX_TABLES, PRICE_INDEX_COLUMNS)
    return ordered(flat, "ano", "mes", "localidade_id", "variavel", "categoria")


def crop_production(star: Star, tables: list[str] | None = None) -> DataFrame:
    """T6."""
    return flatten(star, tables or CROP_TABLES, CROP_COLUMNS)


def point_series(
    star: Star, table: str, place: str, strict: bool = True
) -> DataFrame:
    """One place of one cube, ordered by year and month.

    The documented query casts without a guard; ``strict=False`` gives NULL for
    values that are not numbers.
    """
    located = star._replace(localidade=star.localidade.filter(F.col("d1c") == place))
    value = F.col("d.v")
    number = (
        value.cast("decimal(38,10)") if strict else value.try_cast("decimal(38,10)")
    )
    series = join_star(located, [table]).select(
        *(F.col(source).alias(name) for name, source in SERIES_COLUMNS.items()),
        number.alias("valor"),
    )
    return ordered(series, "ano", "mes")
