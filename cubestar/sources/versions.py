"""Tables that are replaced as a whole: a folder per version, switched by a marker.

A version is written beside the others and counts from the moment its marker file
exists, so a reader sees the version before or the new one and never a part of it.
Files of older versions stay for readers that have begun with them, until
``drop_old_versions`` is called.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

MARKER = "_COMMITTED"
_PREFIX = "version="


def _at(spark: SparkSession, path: str):
    """(file system, path) of the store that holds a path."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, at = _at(spark, path)
    if not fs.exists(at):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    return sorted(int(n.removeprefix(_PREFIX)) for n in names if n.startswith(_PREFIX))


def _folder(path: str, version: int) -> str:
    return f"{path}/{_PREFIX}{version:09d}"


def new_version(spark: SparkSession, path: str) -> str:
    """A folder for the next version; a version that was not finished is not reused."""
    return _folder(path, max(_versions(spark, path), default=0) + 1)


def commit(spark: SparkSession, folder: str) -> None:
    """Make a written version the current one, in one step."""
    fs, at = _at(spark, f"{folder}/{MARKER}")
    fs.create(at, True).close()


def is_committed(spark: SparkSession, folder: str) -> bool:
    return _exists(spark, f"{folder}/{MARKER}")


def committed(spark: SparkSession, path: str) -> list[str]:
    """Folders of the finished versions, oldest first."""
    folders = [_folder(path, v) for v in _versions(spark, path)]
    return [f for f in folders if is_committed(spark, f)]


def current(spark: SparkSession, path: str) -> str:
    found = committed(spark, path)
    if not found:
        raise FileNotFoundError(f"no finished version in {path}")
    return found[-1]


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the newest finished versions; returns what was removed."""
    gone = committed(spark, path)[:-keep]
    for folder in gone:
        remove(spark, folder)
    return gone


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it, if it is there."""
    fs, at = _at(spark, path)
    fs.delete(at, True)
