"""Registered queries and the SQL each result is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query; dates and decimals are compared as text."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return as_text(build(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def as_text(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            f.name: F.col(f.name).cast("string")
            for f in df.schema
            if isinstance(f.dataType, (T.DateType, T.DecimalType))
        }
    )


def map_text(c) -> F.Column:
    """A map of lists as ``key=a,b;key=c``, in entry order."""
    return F.array_join(
        F.transform(
            F.map_entries(c),
            lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ",")),
        ),
        ";",
    )
