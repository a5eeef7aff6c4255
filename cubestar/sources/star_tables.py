"""The star as parquet folders: one per table, facts partitioned.

Catalogue and periods, which a load of descriptions replaces as a whole, lie
together in a folder per version, so that both change at once. Facts lie in one folder per (cube, period), the unit a load replaces. Rows of a
folder are sorted by place, so a filter on a place skips row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cubestar.schema import (
    FACT_COLUMNS,
    FACT_PARTITIONS,
    STAR_SCHEMAS,
    Star,
    empty_star,
)
from cubestar.sources.versions import commit, current, new_version
from cubestar.sources.workdir import PACKED, freed_shuffles

#: Tables that are replaced as a whole, by version.
DESCRIBED = ("tabela_sidra", "periodo")


def table_paths(spark: SparkSession, path: str) -> dict[str, str]:
    """Where each table of a stored star lies now."""
    described = current(spark, f"{path}/described")
    return {
        name: f"{described if name in DESCRIBED else path}/{name}" for name in Star._fields
    }


def read_star(spark: SparkSession, path: str) -> Star:
    return Star(
        *(
            spark.read.schema(STAR_SCHEMAS[name]).parquet(at)
            for name, at in table_paths(spark, path).items()
        )
    )


def replace_described(spark: SparkSession, path: str, tables: dict[str, DataFrame]) -> None:
    """Write catalogue and periods as a new version and switch to it."""
    folder = new_version(spark, f"{path}/described")
    for name in DESCRIBED:
        with freed_shuffles(spark):
            tables[name].write.mode("errorifexists").options(**PACKED).parquet(f"{folder}/{name}")
    commit(spark, folder)


def create_star(spark: SparkSession, path: str) -> Star:
    tables = empty_star(spark)._asdict()
    replace_described(spark, path, tables)
    for name, df in tables.items():
        if name in DESCRIBED:
            continue
        writer = df.write.mode("errorifexists")
        if name == "dados":
            writer = writer.partitionBy(*FACT_PARTITIONS)
        writer.parquet(f"{path}/{name}")
    return read_star(spark, path)


def write_facts(facts: DataFrame, path: str) -> None:
    # Rebalance gathers each (cube, period) into few files and splits a large
    # one into several tasks, whatever share of the rows it holds.
    spread = facts.select(*FACT_COLUMNS).hint("rebalance", *FACT_PARTITIONS)
    with freed_shuffles(facts.sparkSession):
        (
            spread.sortWithinPartitions(*FACT_PARTITIONS, "localidade_id")
            .write.mode("overwrite")
            .options(**PACKED, partitionOverwriteMode="dynamic")
            .partitionBy(*FACT_PARTITIONS)
            .parquet(path)
        )


def register_star(spark: SparkSession, path: str, database: str) -> None:
    """Make a stored star visible to SQL as tables of a database."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, at in table_paths(spark, path).items():
        table = f"`{database}`.`{name}`"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in STAR_SCHEMAS[name]
        )
        layout = (
            f" PARTITIONED BY ({', '.join(FACT_PARTITIONS)})" if name == "dados" else ""
        )
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet{layout}"
            f" LOCATION '{at}'"
        )
        if name == "dados":
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def star_of(spark: SparkSession, database: str) -> Star:
    """A registered star; partitions come from the catalog, not from a listing."""
    return Star(*(spark.table(f"`{database}`.`{name}`") for name in Star._fields))


def refresh_star(spark: SparkSession, database: str, path: str | None = None) -> None:
    """Show a registered star what has been loaded into its folders since.

    With the star's ``path`` its catalogue and periods switch to their current
    version as well; the switch of a table's location is one step of the catalog.
    """
    spark.sql(f"ALTER TABLE `{database}`.`dados` RECOVER PARTITIONS")
    if path is not None:
        where = table_paths(spark, path)
        for name in DESCRIBED:
            spark.sql(f"ALTER TABLE `{database}`.`{name}` SET LOCATION '{where[name]}'")
    for name in Star._fields:
        spark.catalog.refreshTable(f"`{database}`.`{name}`")
