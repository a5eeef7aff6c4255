"""Declared outputs become tables or views."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cubestar.operators.quality import primary_key_violations, unique_violations
from cubestar.plans.clustering import z_order
from cubestar.sources.versions import commit, drop_old_versions, new_version
from cubestar.sources.workdir import PACKED, freed_shuffles, scratch, staged

REQUIRED_FIELDS = ("name", "schema", "strategy", "sql")
STRATEGIES = ("replace", "view")


class KeyViolation(ValueError):
    """An output broke its primary key or a unique index."""


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def check_outputs(outputs: Sequence[Mapping]) -> list[str]:
    """All problems of a list of outputs, empty when it can run."""
    if not isinstance(outputs, Sequence) or isinstance(outputs, str) or not outputs:
        return ["at least one output is needed"]
    problems, seen = [], set()
    for i, output in enumerate(outputs):
        missing = [f for f in REQUIRED_FIELDS if f not in output]
        if missing:
            problems.append(f"output {i}: missing {', '.join(missing)}")
            continue
        if output["strategy"] not in STRATEGIES:
            problems.append(f"output {i}: unknown strategy {output['strategy']!r}")
        target = (output["schema"], output["name"])
        if target in seen:
            problems.append(f"output {i}: duplicate output {'.'.join(target)}")
        seen.add(target)
    return problems


def materialize(
    spark: SparkSession,
    outputs: Sequence[Mapping],
    star_database: str,
    location: str | None = None,
) -> None:
    """Build outputs in list order; a failure keeps the earlier ones.

    Unqualified names in the SQL resolve to ``star_database``; other schemas
    are qualified. ``location`` is the folder for new schemas.
    """
    problems = check_outputs(outputs)
    if problems:
        raise ValueError("; ".join(problems))
    previous = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(star_database)
    try:
        for output in outputs:
            _create_schema(spark, output["schema"], location)
            if output["strategy"] == "view":
                create_view(spark, output)
            else:
                with scratch(spark):
                    replace_table(spark, output)
    finally:
        spark.catalog.setCurrentDatabase(previous)


def _create_schema(spark: SparkSession, schema: str, location: str | None) -> None:
    at = f" LOCATION '{location}/{schema}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(schema)}{at}")


def _comment(output: Mapping) -> str:
    text = output.get("description")
    if not text:
        return ""
    return " COMMENT '" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_view(spark: SparkSession, output: Mapping) -> None:
    """A view over stored tables, always up to date."""
    target = _quoted(output["schema"], output["name"])
    query = output["sql"].strip().rstrip(";")
    spark.sql(f"CREATE OR REPLACE VIEW {target}{_comment(output)} AS {query}")


def replace_table(spark: SparkSession, output: Mapping) -> None:
    """S7 with Q1 to Q3: build beside the target, check, then take its place.

    Every build has a folder of its own. Readers keep the old table until the new
    one has passed its checks; then the table's location is switched in one step of
    the catalog, so a reader finds the old table or the new one. Only if the columns
    changed are tables renamed instead: the old one is moved aside, not dropped,
    until the new one has its name, and comes back if that fails.

    ``partitioned_by`` lists columns whose values get a folder each, which a refresh
    replaces one by one (``plans.refresh``).
    """
    schema, name = output["schema"], output["name"]
    target = _quoted(schema, name)
    building_name = f"{name}__{uuid.uuid4().hex[:8]}"
    building = _quoted(schema, building_name)
    df = spark.sql(output["sql"].strip().rstrip(";"))
    plain = [i for i in output.get("indexes") or [] if not i.get("unique")]
    if plain:
        # Q3: rows lie in the order of the first index, so its filters skip
        # files and row groups. The hash splits a key that fills many ranges.
        # Ranges are found by sampling; the staged rows spare a second run of
        # the query for that.
        df = staged(df, "output")
        first = plain[0]["columns"]
        hashed = [
            f.name for f in df.schema if "map<" not in f.dataType.simpleString()
        ]
        order = [F.col(f"`{c}`") for c in first]
        if len(plain) > 1:
            # Several indexes: one curve through the first columns of all of them, so
            # that a range on any of them meets few files and row groups.
            order = [z_order(df, list(dict.fromkeys(i["columns"][0] for i in plain))), *order]
        df = df.repartitionByRange(*order, F.xxhash64(*hashed))
        df = df.sortWithinPartitions(*order)
    versions = _versions_of(spark, schema, name)
    folder = new_version(spark, versions)
    try:
        writer = df.write.format("parquet").options(**PACKED, path=folder)
        if output.get("partitioned_by"):
            writer = writer.partitionBy(*output["partitioned_by"])
        for column in {c for i in plain[1:] for c in i["columns"]}:
            # Further indexes: a bloom filter per row group answers equality.
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        with freed_shuffles(spark):
            writer.saveAsTable(building)
        _check_keys(spark.table(building), output)
        if output.get("description"):
            spark.sql(
                f"COMMENT ON TABLE {building} IS"
                + _comment(output).replace(" COMMENT", "", 1)
            )
        commit(spark, folder)
        _publish(spark, schema, building, name, folder, _comment(output))
        drop_old_versions(spark, versions)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {building}")
        raise


def _versions_of(spark: SparkSession, schema: str, name: str) -> str:
    """The folder below which the builds of an output lie."""
    return f"{spark.catalog.getDatabase(schema).locationUri.rstrip('/')}/{name}.builds"


def _layout(spark: SparkSession, table: str) -> list[tuple[str, str, bool]]:
    return [(c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(table)]


def _publish(
    spark: SparkSession, schema: str, building: str, name: str, folder: str, comment: str
) -> None:
    """Give a finished build its name; an earlier table stays readable on failure."""
    target = _quoted(schema, name)
    if not spark.catalog.tableExists(target):
        spark.sql(f"ALTER TABLE {building} RENAME TO {target}")
        return
    kind = "VIEW" if spark.catalog.getTable(target).tableType == "VIEW" else "TABLE"
    unpartitioned = not any(p for *_, p in _layout(spark, building))
    if kind == "TABLE" and unpartitioned and _layout(spark, target) == _layout(spark, building):
        spark.sql(f"ALTER TABLE {target} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(target)
        spark.sql(f"COMMENT ON TABLE {target} IS{comment.replace(' COMMENT', '', 1) or ' NULL'}")
        # The build's own entry goes; its files lie outside the catalog's folders.
        spark.sql(f"DROP TABLE IF EXISTS {building}")
        return
    aside = _quoted(schema, f"{name}__old_{uuid.uuid4().hex[:8]}")
    spark.sql(f"ALTER {kind} {target} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {building} RENAME TO {target}")
    except Exception:
        spark.sql(f"ALTER {kind} {aside} RENAME TO {target}")
        raise
    spark.sql(f"DROP {kind} IF EXISTS {aside}")


def _check_keys(df, output: Mapping) -> None:
    key = output.get("primary_key")
    if key and not primary_key_violations(df, key).isEmpty():
        raise KeyViolation(f"{output['name']}: primary key {key} is broken")
    for index in output.get("indexes") or []:
        if index.get("unique") and not unique_violations(df, index["columns"]).isEmpty():
            raise KeyViolation(f"{output['name']}: unique index {index['name']} is broken")
