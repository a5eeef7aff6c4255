"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words are runs of anything but ASCII blanks; ``bytes.split()`` cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c) -> F.Column:
    """Lower-case A-Z only, so that no other character changes or moves."""
    return F.translate(c, UPPER, UPPER.lower())


def utf8(c) -> F.Column:
    """The text as UTF-8 bytes; a null text is empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).cast("binary")


def map_batches(
    df: DataFrame, of: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str
) -> DataFrame:
    """Arrow batches through the function that ``of()`` makes once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = of()
        for batch in batches:
            if batch.num_rows:
                yield step(batch)

    return df.mapInArrow(run, schema)


def carrying(
    docs: DataFrame, carry: list[str] | None, more: str, inputs: list[F.Column]
) -> tuple[DataFrame, str, list[str]]:
    """Rows for a batch function that adds columns beside carried ones.

    Returns the frame (the carried columns as one struct, then the inputs), the
    schema to give to ``mapInArrow`` (the struct, then ``more``), and what to select
    afterwards. A carried column that has the name of an added one is left out.
    """
    added = [c.split()[0] for c in more.split(", ")]
    kept = [c for c in (docs.columns if carry is None else carry) if c.lower() not in added]
    struct = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("none"))
    frame = docs.select(struct.alias("carried"), *inputs)
    schema = T.StructType([frame.schema["carried"], *T.StructType.fromDDL(more).fields])
    return frame, schema, [*(["carried.*"] if kept else []), *added]


def bounded_broadcast(df: DataFrame, rows: int, bound: int) -> DataFrame:
    """Hint a broadcast where the counted rows are within the bound."""
    return F.broadcast(df) if rows <= bound else df
