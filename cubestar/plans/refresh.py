"""T1 after a load: only the parts of an output that the load touched are built again.

An output that is ``partitioned_by`` the cube and the period of its facts can be
refreshed: its SQL runs over the facts of the touched pairs, and the folders of these
pairs are replaced. Keys are checked on what changed: inside it, and against the keys
of the other parts only where the key does not hold both partition columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubestar.operators.quality import primary_key_violations, unique_violations
from cubestar.plans.materialize import KeyViolation, _quoted
from cubestar.schema import FACT_PARTITIONS
from cubestar.sources.versions import remove
from cubestar.sources.workdir import PACKED, broadcast_if_small, freed_shuffles, scratch, staged


def touched_pairs(merged: DataFrame) -> DataFrame:
    """The (cube, period) pairs of a load, from its ``merged`` facts."""
    return merged.select(*FACT_PARTITIONS).distinct()


def _pairs_of(output: Mapping, touched: DataFrame) -> DataFrame:
    """The touched pairs that the output reads, under its own column names."""
    columns = output["partitioned_by"]
    if len(columns) != len(FACT_PARTITIONS):
        raise ValueError(f"{output['name']}: partitioned_by names the cube and the period")
    if output.get("cubes") is not None:
        touched = touched.where(F.col(FACT_PARTITIONS[0]).isin(list(output["cubes"])))
    return touched.select(*(F.col(a).alias(b) for a, b in zip(FACT_PARTITIONS, columns)))


def _build(spark: SparkSession, output: Mapping, star_database: str, touched: DataFrame) -> DataFrame:
    """The output's rows of the touched pairs: its SQL with fewer facts."""
    facts = spark.table(_quoted(star_database, "dados"))
    held = facts.join(broadcast_if_small(touched), list(FACT_PARTITIONS), "left_semi")
    previous = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(star_database)
    # A view of the session hides the table of its name while the SQL is read.
    held.createOrReplaceTempView("dados")
    try:
        return spark.sql(output["sql"].strip().rstrip(";"))
    finally:
        spark.catalog.dropTempView("dados")
        spark.catalog.setCurrentDatabase(previous)


def key_conflicts(changed: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the changed rows that rows of other parts hold as well; NULL never does."""
    mine = changed.select(*keys).dropna()
    return mine.join(others.select(*keys), list(keys), "left_semi")


def _check_changed(output: Mapping, changed: DataFrame, others: DataFrame) -> None:
    name, parts = output["name"], set(output["partitioned_by"])
    checks = [(output["primary_key"], primary_key_violations)] if output.get("primary_key") else []
    checks += [(i["columns"], unique_violations) for i in output.get("indexes") or [] if i.get("unique")]
    for keys, violations in checks:
        broken = not violations(changed, keys).isEmpty()
        if not broken and not parts <= set(keys):
            broken = not key_conflicts(changed, others, keys).isEmpty()
        if broken:
            raise KeyViolation(f"{name}: key {list(keys)} is broken")


def refresh_output(spark: SparkSession, output: Mapping, star_database: str, touched: DataFrame) -> int:
    """Build the touched parts of a stored output again; returns how many there are.

    ``touched`` has the fact columns of cube and period. Nothing is written if a key
    would be broken. Repeating a refresh, or doing it after a load that was repeated,
    gives the same files' content.
    """
    with scratch(spark):
        return _refresh(spark, output, star_database, touched)


def _refresh(spark: SparkSession, output: Mapping, star_database: str, touched: DataFrame) -> int:
    columns = list(output["partitioned_by"])
    target = _quoted(output["schema"], output["name"])
    wanted = staged(_pairs_of(output, touched.select(*FACT_PARTITIONS).distinct()), "refreshed")
    n = wanted.count()
    if not n:
        return 0
    renamed = wanted.select(*(F.col(b).alias(a) for a, b in zip(FACT_PARTITIONS, columns)))
    built = staged(_build(spark, output, star_database, renamed), "rebuilt")
    stored = spark.table(target)
    small = broadcast_if_small(wanted)
    _check_changed(output, built, stored.join(small, columns, "left_anti"))
    location = spark.sql(f"DESCRIBE FORMATTED {target}").where("col_name = 'Location'").first()["data_type"]
    gone = stored.select(*columns).distinct().join(small, columns).join(
        built.select(*columns).distinct(), columns, "left_anti"
    )
    emptied = [tuple(r) for r in gone.collect()]  # at most the touched pairs
    with freed_shuffles(spark):
        (
            built.select(*stored.columns)
            .hint("rebalance", *columns)
            .write.mode("overwrite")
            .options(**PACKED, partitionOverwriteMode="dynamic")
            .partitionBy(*columns)
            .parquet(location)
        )
    for values in emptied:
        spec = ", ".join(f"`{c}` = '{v}'" for c, v in zip(columns, values))
        folders = "/".join(f"{c}={v}" for c, v in zip(columns, values))
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({spec})")
        remove(spark, f"{location}/{folders}")
    spark.sql(f"ALTER TABLE {target} RECOVER PARTITIONS")
    spark.catalog.refreshTable(target)
    return n
