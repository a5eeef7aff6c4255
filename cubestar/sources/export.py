"""Dimension members as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cubestar.schema import DIMENSION_COLUMNS


def export_members(members: DataFrame, path: str) -> None:
    """Header, sixteen columns in fixed order, UTF-8, NULL as empty field."""
    (
        members.select(*DIMENSION_COLUMNS)
        .write.option("header", True)
        .option("encoding", "UTF-8")
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
