"""Token ids in plane files: fixed-size blocks, byte planes, a chunk index.

Documents are range-partitioned by id; a task encodes its range, cuts the ids
into blocks of ``BLOCK_IDS`` and transposes each block into planes (all lowest
bytes, then the next; or bits) that zstandard compresses one by one. Zero planes
vanish. A chunk is one self-contained binary record with its directory of
documents, stored as a row of a table that Spark commits, so that a repeated task
replaces and never doubles its part. The index table has one row per chunk.

Chunk layout (little-endian): magic ``PLN1``, uint32 ids, uint8 plane kind (8:
byte planes, 1: bit planes), uint8 planes, uint32 length of each plane, planes.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cubestar.llm.common import utf8
from cubestar.llm.tokenizing import cache_of, vocabulary_path
from cubestar.sources.workdir import new_path

BLOCK_IDS = 1 << 16
MAGIC = b"PLN1"
END_ID = 2
#: Bytes of text that a task encodes at a time.
BATCH_BYTES = 4 << 20

_CHUNKS = pa.schema(
    [
        ("part", pa.int32()),
        ("chunk", pa.int64()),
        ("n_ids", pa.int64()),
        ("payload", pa.binary()),
        (
            "documents",
            pa.list_(
                pa.struct(
                    [
                        ("seq", pa.int64()),
                        ("doc_id", pa.int64()),
                        ("offset", pa.int64()),
                        ("length", pa.int64()),
                    ]
                )
            ),
        ),
    ]
)
_CHUNK_SCHEMA = (
    "part int, chunk long, n_ids long, payload binary,"
    " documents array<struct<seq:long,doc_id:long,offset:long,length:long>>"
)


def pack(ids: np.ndarray, kind: int = 8, level: int = 3) -> bytes:
    """A block of ids as a chunk."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    by_byte = ids.view(np.uint8).reshape(-1, 4).T if len(ids) else np.zeros((4, 0), np.uint8)
    if kind == 8:
        planes = list(by_byte)
    else:
        planes = [np.packbits((row >> b) & 1) for row in by_byte for b in range(8)]
    compress = zstandard.ZstdCompressor(level=level).compress
    packed = [compress(p.tobytes()) if p.any() else b"" for p in planes]
    head = struct.pack("<4sIBB", MAGIC, len(ids), kind, len(planes))
    return head + struct.pack(f"<{len(planes)}I", *map(len, packed)) + b"".join(packed)


def unpack(chunk: bytes) -> np.ndarray:
    """The ids of a chunk."""
    magic, n, kind, n_planes = struct.unpack_from("<4sIBB", chunk)
    if magic != MAGIC or (kind, n_planes) not in ((8, 4), (1, 32)):
        raise ValueError("not a chunk of plane-coded ids")
    at = 10 + 4 * n_planes
    planes = np.zeros((4, n), np.uint8)
    expand = zstandard.ZstdDecompressor().decompress
    for p, length in enumerate(struct.unpack_from(f"<{n_planes}I", chunk, 10)):
        if length:
            plane = np.frombuffer(expand(chunk[at : at + length]), np.uint8)
            if kind == 8:
                planes[p] = plane
            else:
                planes[p // 8] |= np.unpackbits(plane, count=n) << (p % 8)
        at += length
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


class _Writer:
    """Documents in, chunk rows out; a document may span chunks."""

    def __init__(self, part: int, block: int, kind: int):
        self.part, self.block, self.kind = part, block, kind
        self.chunk = self.seq = 0
        self.parts: list[np.ndarray] = []
        self.filled, self.entries = 0, []

    def flush(self) -> dict:
        ids = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint32)
        row = {
            "part": self.part,
            "chunk": self.chunk,
            "n_ids": len(ids),
            "payload": pack(ids, self.kind),
            "documents": self.entries,
        }
        self.chunk, self.parts, self.filled, self.entries = self.chunk + 1, [], 0, []
        return row

    def add(self, doc_id, ids: np.ndarray):
        while True:
            take = min(len(ids), self.block - self.filled)
            self.entries.append(
                {"seq": self.seq, "doc_id": doc_id, "offset": self.filled, "length": take}
            )
            self.parts.append(ids[:take])
            self.filled += take
            ids = ids[take:]
            if self.filled == self.block:
                yield self.flush()
            if not len(ids):
                break
        self.seq += 1


def encode_documents(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = END_ID,
    block: int = BLOCK_IDS,
    kind: int = 8,
    partitions: int | None = None,
) -> DataFrame:
    """Chunk rows of all documents in ascending doc_id order.

    ``docs`` has doc_id and text; a null text is empty and yields its end id.
    Null ids come first. Rows with equal ids are ordered by the text's hash;
    the running number deals repeated rows to several tasks. Columns other than
    doc_id and text are ignored. An empty table has no chunks.
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ("doc_id", "_hash", "_row")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text")
    ).select(
        "doc_id",
        "text",
        F.xxhash64("text").alias("_hash"),
        F.monotonically_increasing_id().alias("_row"),
    )
    ordered = (
        rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    )

    def run(batches):
        cache = cache_of("word", vocabulary)
        writer = _Writer(TaskContext.get().partitionId(), block, kind)
        end = np.array([end_id], np.uint32)

        def encoded(doc_ids, texts):
            ids, bounds = cache.laid_out(texts)
            for doc_id, a, b in zip(doc_ids, bounds.tolist(), bounds[1:].tolist()):
                yield from writer.add(doc_id, np.append(ids[a:b].astype(np.uint32), end))

        def chunks():
            for batch in batches:
                doc_ids, texts, at = batch.column(0).to_pylist(), batch.column(1), 0
                upto = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
                while at < len(texts):
                    size = BATCH_BYTES + (upto[at - 1] if at else 0)
                    to = min(int(np.searchsorted(upto, size)) + 1, len(texts))
                    yield from encoded(doc_ids[at:to], texts[at:to])
                    pa.default_memory_pool().release_unused()
                    at = to
            if writer.filled:
                yield writer.flush()

        for row in chunks():
            yield pa.RecordBatch.from_pylist([row], schema=_CHUNKS)

    return ordered.mapInArrow(run, _CHUNK_SCHEMA)


def write_planes(docs: DataFrame, path: str, vocabulary: str, **options) -> None:
    """Write ``chunks`` and ``index`` below the path."""
    spark = docs.sparkSession
    encode_documents(docs, vocabulary, **options).write.parquet(f"{path}/chunks")
    stored = spark.read.parquet(f"{path}/chunks")
    per_part = stored.groupBy("part").agg(F.sum("n_ids").alias("n_part"))
    # One row per writing task, so a single window is bounded by their number.
    first = F.coalesce(
        F.sum("n_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    parts = per_part.select("part", first.alias("part_start"))
    in_part = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    stored.select("part", "chunk", "n_ids", F.length("payload").alias("n_bytes")).join(
        parts, "part"
    ).select(
        "part",
        "chunk",
        "n_ids",
        "n_bytes",
        (F.col("part_start") + F.coalesce(F.sum("n_ids").over(in_part), F.lit(0))).alias("start"),
    ).write.parquet(f"{path}/index")


def crc32_combine(crc_a: int, crc_b: int, length_b: int) -> int:
    """The crc32 of a joined with b, from both crcs and the length of b in bytes."""
    if not length_b:
        return crc_a
    # Columns of the operator that appends one zero bit, then squared per bit of the length.
    operator = [0xEDB88320] + [1 << i for i in range(31)]
    bits = length_b * 8
    while bits:
        if bits & 1:
            crc_a = _apply(operator, crc_a)
        bits >>= 1
        operator = [_apply(operator, column) for column in operator]
    return crc_a ^ crc_b


def _apply(operator: list[int], vector: int) -> int:
    out, at = 0, 0
    while vector:
        if vector & 1:
            out ^= operator[at]
        vector >>= 1
        at += 1
    return out


_PIECES = pa.schema(
    [
        ("part", pa.int32()),
        ("seq", pa.int64()),
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("n", pa.int64()),
        ("crc", pa.int64()),
    ]
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files.

    Chunks are decoded on their own, wherever they lie; a document's pieces are
    joined by their order, and their checksums by arithmetic.
    """
    index = spark.read.parquet(f"{path}/index").select("part", "chunk", "start")
    chunks = spark.read.parquet(f"{path}/chunks").join(index, ["part", "chunk"])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"])
                if len(ids) != row["n_ids"]:
                    raise ValueError("a chunk has another length than its row says")
                pieces = []
                for d in row["documents"]:
                    own = ids[d["offset"] : d["offset"] + d["length"]]
                    pieces.append(
                        {
                            "part": row["part"],
                            "seq": d["seq"],
                            "doc_id": d["doc_id"],
                            "start": row["start"] + d["offset"],
                            "n": len(own),
                            "crc": zlib.crc32(own.tobytes()),
                        }
                    )
                yield pa.RecordBatch.from_pylist(pieces, schema=_PIECES)

    pieces = chunks.select("part", "chunk", "start", "n_ids", "payload", "documents").mapInArrow(
        run, "part int, seq long, doc_id long, start long, n long, crc long"
    )
    documents = pieces.groupBy("part", "seq").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("start").alias("start"),
        F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("start", "n", "crc"))).alias("pieces"),
    )

    @F.pandas_udf("long")
    def joined(pieces):
        def one(parts):
            crc = 0
            for p in parts:
                crc = crc32_combine(crc, p["crc"], 4 * p["n"])
            return crc

        return pieces.map(one)

    single, several = F.size("pieces") == 1, F.size("pieces") > 1
    columns = ("doc_id", "start", "n_tokens")
    return (
        documents.where(single)
        .select(*columns, F.col("pieces")[0]["crc"].alias("ids_crc32"))
        .unionByName(documents.where(several).select(*columns, joined("pieces").alias("ids_crc32")))
    )


def store_tokens(docs: DataFrame, vocabulary: str | None = None, path: str | None = None) -> DataFrame:
    """Write all documents and return what the files say about each."""
    spark = docs.sparkSession
    path = path or new_path(spark, "planes")
    write_planes(docs, path, vocabulary or vocabulary_path("word_bpe_49k.json"))
    return read_documents(spark, path)
