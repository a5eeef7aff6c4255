"""S1 for documents of any size: a JSON array is read in parts.

The file is cut at every ``}``, which Spark's text reader does at any offset, so one
document is read by as many tasks as it has blocks. Rows are flat objects: a cut
ends a row unless it falls into a text. Whether a block begins inside a text, and how
many rows begin before it, follows from the blocks before: a first pass sums each
block up for both cases, in one row, and these rows are added up along the file. The
second pass puts rows together and numbers them; a row that is cut by a brace in a
text at the edge of a block is joined from its fragments.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cubestar.functions.codes import null_sentinels
from cubestar.schema import RAW_COLUMNS
from cubestar.sources.documents import explode_documents, file_name, observation_documents
from cubestar.sources.workdir import broadcast_if_small, staged

#: Documents of more bytes are read in parts.
WHOLE_BYTES = 64 << 20
#: Blocks are broadcast up to this number; each is a row of few bytes.
MAX_BLOCKS = 1_000_000

_CUT = "}"


def _odd_quotes(piece: Column) -> Column:
    """Whether a piece has an odd number of quotes that open or close a text."""
    plain = F.replace(F.replace(piece, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    return F.length(plain) % 2 != F.length(F.replace(plain, F.lit('"'), F.lit(""))) % 2


def read_pieces(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """file_path, block (its offset), piece: the text between two cuts, in order."""
    reader = spark.read.option("lineSep", _CUT).options(**options)
    return reader.text(path, recursiveFileLookup="basePath" not in options).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("piece"),
    )


_SUMS = "file_path string, block long, odd boolean, outside long, inside long"


def _blocks(batch) -> np.ndarray:
    """Rows of a batch at which another block begins than that of the row before."""
    n, path, block = batch.num_rows, batch.column(0), batch.column(1)
    other = pc.or_(
        pc.not_equal(path.slice(1), path.slice(0, n - 1)), pc.not_equal(block.slice(1), block.slice(0, n - 1))
    )
    return np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1


def _sums(batches):
    """One row per block: whether it changes the state, rows that begin in it if it
    begins outside (0) or inside (1) of a text.

    Batches have file_path, block, odd (quotes) and opens (a brace) of every piece.
    """
    at, odd, counts = None, False, [0, 0]

    def done():
        return pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip((*at, odd, *counts), (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()))],
            names=["file_path", "block", "odd", "outside", "inside"],
        )

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        odds, opens = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
        after = np.cumsum(odds)
        starts = [0, *_blocks(batch), n]
        for first, end in zip(starts, starts[1:]):
            here = (batch.column(0)[first].as_py(), batch.column(1)[first].as_py())
            if here != at:
                if at is not None:
                    yield done()
                at, odd, counts = here, False, [0, 0]
            begun = after[first] - odds[first]
            # The pieces that begin outside of a text if the block does.
            state = (after[first:end] - odds[first:end] - begun + odd) & 1
            inside = int((state * opens[first:end]).sum())
            counts[0] += int(opens[first:end].sum()) - inside
            counts[1] += inside
            odd ^= bool((after[end - 1] - begun) & 1)
    if at is not None:
        yield done()


def _block_states(pieces: DataFrame) -> DataFrame:
    """file_path, block, begins_inside, before (rows that begin earlier in the file) and
    cut (a row goes on over an edge of the block), of blocks that need them: the first
    of a file begins outside, with no rows before."""
    piece = F.col("piece")
    signs = pieces.select("file_path", "block", _odd_quotes(piece).alias("odd"), F.contains(piece, F.lit("{")).alias("opens"))
    sums = staged(signs.mapInArrow(_sums, _SUMS), "blocks")
    in_file = Window.partitionBy("file_path").orderBy("block")
    along = in_file.rowsBetween(Window.unboundedPreceding, -1)
    states = sums.withColumn(
        "begins_inside", F.coalesce(F.bit_xor(F.col("odd").cast("int")).over(along), F.lit(0)) == 1
    )
    begun = F.when(F.col("begins_inside"), F.col("inside")).otherwise(F.col("outside"))
    ends_inside = F.coalesce(F.lead("begins_inside").over(in_file), F.lit(False))
    return states.withColumns({"begun": begun, "ends_inside": ends_inside}).select(
        "file_path", "block", "begins_inside", F.coalesce(F.sum("begun").over(along), F.lit(0)).alias("before"),
        (F.col("begins_inside") | F.col("ends_inside")).alias("cut"),
    ).where("cut OR before > 0")


_RECORDS = "file_path string, pos long, part long, record string"


def _whole(batch, at, pos: int):
    """(rows, place, number) after a batch whose pieces are a whole row each, else None."""
    path, block, piece, before = (batch.column(i) for i in (0, 1, 2, 4))
    n, opens = batch.num_rows, pc.match_substring(piece, "{")
    texts = pc.utf8_ltrim(piece.filter(opens), characters="[, \t\r\n")
    if not n or not pc.all(pc.starts_with(texts, "{"), min_count=0).as_py():
        return None
    begun = opens.to_numpy(zero_copy_only=False).astype(np.int64)
    rows, starts = np.cumsum(begun), np.array([0, *_blocks(batch)])
    base = before.to_numpy(zero_copy_only=False)[starts] - 1
    if (path[0].as_py(), block[0].as_py()) == at:
        base[0] = pos
    numbers = np.repeat(base - rows[starts] + begun[starts], np.diff([*starts, n])) + rows
    columns = [
        path.filter(opens), pa.array(numbers[begun == 1], pa.int64()),
        pa.array(np.full(len(texts), -1), pa.int64()), pc.binary_join_element_wise(texts, _CUT, ""),
    ]
    found = pa.RecordBatch.from_arrays(columns, names=["file_path", "pos", "part", "record"])
    return found, (path[n - 1].as_py(), block[n - 1].as_py()), int(numbers[-1])


def _records(batches):
    """Rows of each block. A row that is whole has part -1; fragments of a row have the
    offset of their block, and the row's number is that of the block it begins in."""
    at, inside, pos, held, open_row = None, False, 0, [], False
    out: list[tuple] = []

    def left():
        # What is open at the end of a block goes on in the next one.
        if held:
            out.append((at[0], pos, at[1], _CUT.join(held) + _CUT))

    def batch_of():
        columns = zip(*out) if out else ((), (), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
            names=["file_path", "pos", "part", "record"],
        )

    for batch in batches:
        # Without a brace in a text, every piece is a row.
        in_text = pc.any(pc.or_(batch.column(3), batch.column(5)), min_count=0).as_py()
        if not held and not in_text and (whole := _whole(batch, at, pos)):
            found, at, pos = whole
            inside = open_row = False
            yield found
            continue
        for path, block, piece, begins_inside, before, odd in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if (path, block) != at:
                left()
                at, inside, pos, held = (path, block), begins_inside, before - 1, []
                open_row = begins_inside  # begun in an earlier block
            if not inside:
                if "{" not in piece:
                    continue  # the end of the array
                pos += 1
                piece = piece[piece.index("{") :]
            held.append(piece)
            inside ^= odd
            if not inside:
                record = _CUT.join(held) + _CUT
                out.append((path, pos, block if open_row else -1, record))
                held, open_row = [], False
        yield batch_of()
        out = []
    left()
    yield batch_of()


def split_records(pieces: DataFrame) -> DataFrame:
    """file_path, pos, record: the JSON text of every element of every document."""
    states = staged(_block_states(pieces), "block-states")
    # Only blocks behind the first of a document, and those with a cut row, are listed.
    listed = broadcast_if_small(states, MAX_BLOCKS)
    placed = pieces.withColumn("seq", F.monotonically_increasing_id()).join(listed, ["file_path", "block"], "left")
    placed = placed.select(
        "file_path", "block", "piece", F.coalesce("begins_inside", F.lit(False)).alias("begins_inside"),
        F.coalesce("before", F.lit(0)).alias("before"), _odd_quotes(F.col("piece")).alias("odd"), "seq",
        F.coalesce("cut", F.lit(False)).alias("cut"),
    )
    if "Broadcast" not in placed._jdf.queryExecution().executedPlan().toString():
        n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = placed.repartition(n, "file_path", "block").sortWithinPartitions("file_path", "block", "seq")

    def found(rows: DataFrame) -> DataFrame:
        return rows.drop("seq", "cut").mapInArrow(_records, _RECORDS)

    whole = found(placed).where("part < 0").select("file_path", "pos", "record")
    if states.where("cut").isEmpty():
        return whole
    # A row's first fragment lacks part -1 only if it was cut: all its parts are joined.
    fragments = found(placed.where("cut")).where("part >= 0").groupBy("file_path", "pos").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("part", "record"))), lambda x: x["record"]), ""
        ).alias("record")
    )
    return whole.unionByName(fragments)


def rows_of_records(
    records: DataFrame, extra_columns: Iterable[str] = (), keep_flags: bool = False
) -> DataFrame:
    """S1 and S2 on elements: as ``explode_documents`` gives them for whole documents."""
    columns = [*RAW_COLUMNS, *extra_columns]
    row_type = ", ".join(f"`{c}`: STRING" for c in columns)
    parsed = records.filter("pos > 0").select(
        "file_path",
        F.col("pos").cast("int").alias("pos"),
        F.from_json("record", f"STRUCT<{row_type}>", {"mode": "FAILFAST"}).alias("row"),
    )
    flat = parsed.select("file_path", "pos", *(F.col(f"row.`{c}`").alias(c) for c in columns))
    return null_sentinels(flat, [c for c in columns if not (keep_flags and c == "V")])


def read_rows(
    spark: SparkSession, path: str | list[str], whole_bytes: int = WHOLE_BYTES, **options
) -> DataFrame:
    """Data rows of all documents below a path; large ones are read in parts.

    The files are listed once with their sizes; only the names of the large ones,
    of which a store holds at most its size over ``whole_bytes``, come to the driver.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .load(path)
        .select(F.col("_metadata.file_path").alias("file_path"), "length")
    )
    listed = staged(observation_documents(files), "listed")
    large = [r.file_path for r in listed.where(F.col("length") > whole_bytes).collect()]
    docs = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True, recursiveFileLookup=True)
    named = docs.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"), "value"
    )
    small = observation_documents(named).where(F.col("file_size") <= whole_bytes)
    rows = explode_documents(small, **options)
    if large:
        rows = rows.unionByName(rows_of_records(split_records(read_pieces(spark, large)), **options))
    return rows
