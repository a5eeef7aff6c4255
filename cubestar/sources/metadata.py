"""Nested cube descriptions and their flat projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cubestar.functions.codes import normalize_level
from cubestar.schema import METADATA, PERIOD_ATTRIBUTES


def read_metadata(
    spark: SparkSession, path: str | list[str], multiline: bool = True
) -> DataFrame:
    """One row per cube description, nested as in ``schema.METADATA``.

    ``multiline=False`` reads JSON lines, the form to keep many cubes in.
    """
    return spark.read.schema(METADATA).json(
        path, multiLine=multiline, mode="FAILFAST", recursiveFileLookup=True
    )


def metadata_json() -> Column:
    """The whole description as JSON text; dates as text, nulls kept."""
    return F.to_json(
        F.struct(*METADATA.fieldNames()), {"ignoreNullFields": "false"}
    )


def catalogue_rows(metadata: DataFrame) -> DataFrame:
    return metadata.select(
        "id",
        "nome",
        F.col("periodicidade.frequencia").alias("periodicidade"),
        metadata_json().alias("metadados"),
    )


def period_rows(metadata: DataFrame) -> DataFrame:
    exploded = metadata.select(
        F.col("id").alias("tabela_sidra_id"),
        F.posexplode("periodos").alias("pos", "p"),
    )
    return exploded.select(
        "tabela_sidra_id",
        "pos",
        F.col("p.id").alias("codigo"),
        "p.literals",
        *(f"p.{a}" for a in PERIOD_ATTRIBUTES),
        "p.modificacao",
    )


def place_rows(metadata: DataFrame) -> DataFrame:
    """Places of every cube; level codes normalised as for data rows."""
    exploded = metadata.select(
        F.col("id").alias("tabela_sidra_id"),
        F.posexplode("localidades").alias("pos", "l"),
    )
    return exploded.select(
        "tabela_sidra_id",
        "pos",
        F.expr(normalize_level("coalesce(l.nivel.id, '')")).alias("nc"),
        F.coalesce("l.nivel.nome", F.lit("")).alias("nn"),
        F.coalesce("l.id", F.lit("")).alias("d1c"),
        F.coalesce("l.nome", F.lit("")).alias("d1n"),
    )


def variable_rows(metadata: DataFrame) -> DataFrame:
    return metadata.select(
        F.col("id").alias("tabela_sidra_id"),
        F.posexplode("variaveis").alias("pos", "v"),
    ).select("tabela_sidra_id", "pos", "v.id", "v.nome", "v.unidade")


def category_rows(metadata: DataFrame) -> DataFrame:
    return (
        metadata.select(
            F.col("id").alias("tabela_sidra_id"),
            F.posexplode("classificacoes").alias("pos", "c"),
        )
        .select(
            "tabela_sidra_id",
            "pos",
            F.col("c.id").alias("cls_id"),
            F.posexplode("c.categorias").alias("cat_pos", "k"),
        )
        .select(
            "tabela_sidra_id", "pos", "cls_id", "cat_pos",
            F.col("k.id").alias("cat_id"), "k.nome", "k.unidade",
        )
    )
