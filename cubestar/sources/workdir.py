"""Shared working folder: intermediate tables survive the loss of executors."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubestar.sources.versions import remove

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a session whose tasks run in the driver's process (``local[n]``) gets a
    temporary folder without that setting; other executors would not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if configured:
        return f"{configured.rstrip('/')}/cubestar/{app}"
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="cubestar-")
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: Spark removes the shuffle files of a statement when it ends; else they stay until
#: the driver happens to collect its garbage.
_FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Tables that are written to be read again soon are packed more than Spark does by default.
PACKED = {"compression": "zstd"}


#: Java does not compile longer methods; Spark then uses several instead of one per stage.
_METHOD_LIMIT = {"spark.sql.codegen.hugeMethodLimit": "8000"}


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def freed_shuffles(spark: SparkSession):
    """For writes of wide rows: their shuffle files are gone when each of them ends."""
    return _settings(spark, {_FREES_SHUFFLES: "true", **_METHOD_LIMIT})


def write_freed(df: DataFrame, path: str, **options) -> None:
    """Write a packed table; the shuffle files of the write are gone when it ends."""
    with freed_shuffles(df.sparkSession):
        df.write.options(**PACKED, **options).parquet(path)


def stage(df: DataFrame, name: str, free_shuffles: bool = False) -> DataFrame:
    """Write once and read back; later steps start from the written table.

    With ``free_shuffles`` the shuffle files of the write are gone when it ends.
    """
    path = new_path(df.sparkSession, name)
    if free_shuffles:
        with _settings(df.sparkSession, {_FREES_SHUFFLES: "true"}):
            df.write.parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``stage`` for large tables: packed, and without shuffle files left behind."""
    path = new_path(df.sparkSession, name)
    if getattr(_made, "paths", None) is not None:
        _made.paths.append(path)
    write_freed(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_made = threading.local()


@contextmanager
def scratch(spark: SparkSession):
    """What is ``staged`` inside goes at the end; nothing may read it afterwards."""
    before, _made.paths = getattr(_made, "paths", None), []
    try:
        yield
    finally:
        for path in _made.paths:
            remove(spark, path)
        _made.paths = before


def broadcast_if_small(
    df: DataFrame, max_rows: int = 200_000, count_of: DataFrame | None = None
) -> DataFrame:
    """Hint a broadcast only after counting that the side is small.

    Meant for narrow lookup sides. ``count_of`` is a frame that is cheaper to
    count and bounds the side. Beyond ``max_rows`` the side is returned
    unchanged and the join shuffles, with AQE splitting skewed partitions.
    """
    counted = df.limit(max_rows + 1) if count_of is None else count_of
    if counted.count() <= max_rows:
        return F.broadcast(df)
    return df
