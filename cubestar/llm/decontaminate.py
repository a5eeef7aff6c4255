"""Benchmark decontamination by spaced-seed hashing.

Each mask hashes some positions of a run of words and ignores the others. Test
and training texts meet in a join on equal hashes; around every hit the two texts
are aligned and compared word by word, and a window with few substitutions makes
an overlap. The masks are fixed so that any window of ``WINDOW`` words, or any
shorter item, with up to a fifth of its words replaced keeps a whole seed; items
below ``SHORT_ITEM`` words need the last mask for that, longer ones do not use it.

Training hashes go through a bitmap of the test hashes first. The bitmap has a
fixed size; a large benchmark fills it, so that more hashes reach the join, and
the result stays the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubestar.llm.common import utf8
from cubestar.sources.workdir import stage

#: Positions that each mask reads.
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 2, 4, 8, 9), (0, 1, 2, 4, 5, 6), (0, 1, 2, 3))
WINDOW = 20
SHORT_ITEM = 17
MAX_REPLACED = 0.2
MIN_ITEM_WORDS = 8
BITMAP_BITS = 24
MAX_CODES = 400_000

_ODD = np.array([(0x9E3779B97F4A7C15 * (2 * k + 3)) & (2**64 - 1) | 1 for k in range(16)], np.uint64)


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_CODES:
            self.clear()
        self[word] = code = xxhash.xxh3_64_intdigest(word)
        return code


def word_codes(text: bytes, codes: _Codes) -> np.ndarray:
    """A 64-bit code for each word; A-Z count as a-z."""
    words = text.lower().split()
    return np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))


def masks_of(n_words: int) -> tuple[tuple[int, ...], ...]:
    """The masks that an item of so many words is indexed by."""
    return MASKS if n_words < SHORT_ITEM else MASKS[:-1]


def seed_hashes(codes: np.ndarray, masks=MASKS):
    """The hashes by start for every mask that fits."""
    for m, mask in enumerate(masks):
        n = len(codes) - mask[-1]
        if n > 0:
            mixed = np.full(n, _ODD[-1 - m], np.uint64)
            for k, p in enumerate(mask):
                mixed = mixed + codes[p : p + n] * _ODD[k]
            yield mixed ^ (mixed >> np.uint64(29))


def window_of(n_words: int) -> tuple[int, int]:
    """(window, equal words needed) for an item of so many words."""
    window = min(WINDOW, n_words)
    return window, window - int(MAX_REPLACED * window)


def best_overlap(item: np.ndarray, segment: np.ndarray, shifts: list[int]) -> int:
    """The most equal words in a window, item word i beside segment word i + shift.

    Item words beyond the segment's ends count as replaced.
    """
    window, _ = window_of(len(item))
    best = 0
    for shift in shifts:
        low, high = max(0, -shift), min(len(item), len(segment) - shift)
        equal = np.zeros(len(item) + 1, np.int64)
        if low < high:
            equal[low + 1 : high + 1] = item[low:high] == segment[low + shift : high + shift]
        equal = np.cumsum(equal)
        best = max(best, int((equal[window:] - equal[:-window]).max()))
        if best == window:
            break
    return best


def _benchmark_tables(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items: item, codes; seeds: hash, item, at), one item per distinct text."""

    def run(batches):
        codes = _Codes()
        for batch in batches:
            rows = []
            for value in batch.column(0):
                words = word_codes(value.as_py(), codes)
                if len(words) >= MIN_ITEM_WORDS:
                    hits = [
                        (h, at)
                        for hashes in seed_hashes(words, masks_of(len(words)))
                        for at, h in enumerate(hashes.view(np.int64).tolist())
                    ]
                    rows.append((xxhash.xxh3_64_intdigest(words.tobytes()) >> 1, words.tobytes(), hits))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.binary()),
                    pa.array([[{"hash": h, "at": at} for h, at in r[2]] for r in rows], _SEEDS),
                ],
                names=["item", "codes", "seeds"],
            )

    texts = benchmark.select(utf8("text").alias("text")).distinct()
    items = stage(
        texts.mapInArrow(run, "item long, codes binary, seeds array<struct<hash:long,at:long>>").dropDuplicates(["item"]),
        "benchmark",
    )
    seeds = items.select("item", F.explode("seeds").alias("s")).select("item", "s.hash", "s.at")
    return items.select("item", "codes"), seeds


_SEEDS = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int64())]))


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """2 ** BITMAP_BITS bits; summed on the executors into words of 64 bits."""
    slot = F.shiftrightunsigned("hash", 64 - BITMAP_BITS)
    words = (
        seeds.select(F.shiftright(slot, 6).alias("word"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    )
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for row in words.collect():  # at most that many rows, whatever the benchmark
        out[row["word"]] = row["bits"]
    return np.unpackbits(out.view(np.uint8), bitorder="little")


_SEGMENTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("digest", pa.binary()),
        ("start", pa.int64()),
        ("codes", pa.binary()),
        ("seeds", _SEEDS),
    ]
)


def segments(docs: DataFrame, bitmap: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """The stretches of every text around hashes that may be test hashes.

    ``digest`` names the text, so equal texts have equal segments.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    margin = WINDOW + max(m[-1] for m in MASKS)

    def run(batches):
        codes, bits = _Codes(), shared.value
        for batch in batches:
            rows = []
            for number, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = value.as_py()
                words = word_codes(raw, codes)
                hits = []
                for hashes in seed_hashes(words):
                    at = np.flatnonzero(bits[hashes >> np.uint64(64 - BITMAP_BITS)])
                    hits += zip(at.tolist(), hashes[at].view(np.int64).tolist())
                hits.sort()
                digest = xxhash.xxh3_128_digest(raw) if hits else b""
                group: list[tuple[int, int]] = []
                for hit in [*hits, (1 << 62, 0)]:
                    if group and hit[0] - group[-1][0] > 2 * margin:
                        start = max(0, group[0][0] - margin)
                        rows.append(
                            {
                                "doc_id": number,
                                "digest": digest,
                                "start": start,
                                "codes": words[start : group[-1][0] + 2 * margin].tobytes(),
                                "seeds": [{"hash": h, "at": p - start} for p, h in group],
                            }
                        )
                        group = []
                    group.append(hit)
            yield pa.RecordBatch.from_pylist(rows, schema=_SEGMENTS)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(text).alias("text"))
    return rows.mapInArrow(
        run,
        "doc_id long, digest binary, start long, codes binary, seeds array<struct<hash:long,at:long>>",
    )


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
) -> DataFrame:
    """doc_id, item_id, n_equal, n_window of every overlapping pair.

    A pair overlaps where a window of ``WINDOW`` words (the whole item, if it is
    shorter) has at most a fifth of its words replaced; ``n_equal`` is the most
    equal words in one window. Items of fewer than ``MIN_ITEM_WORDS`` words and
    null or empty texts overlap with nothing. Rows with a null id are reported
    with a null id; repeated rows and items of equal text give one row per pair
    of ids. Other columns are ignored.
    """
    benchmark = benchmark.select(F.col(item_id).alias("item_id"), F.col("text").alias("text"))
    items, seeds = _benchmark_tables(benchmark)
    found = stage(segments(docs, _bitmap(seeds), doc_id, text), "segments")
    held = found.groupBy("digest", "start").agg(F.first("codes").alias("codes"), F.first("seeds").alias("seeds"))
    hits = held.select("digest", "start", F.explode("seeds").alias("s")).select(
        "digest", "start", F.col("s.hash").alias("hash"), F.col("s.at").alias("held_at")
    )
    aligned = (
        hits.join(seeds, "hash")
        .groupBy("digest", "start", "item")
        .agg(F.collect_set(F.col("held_at") - F.col("at")).alias("shifts"))
        .join(found.select("digest", "start", F.col("codes").alias("segment")).dropDuplicates(["digest", "start"]), ["digest", "start"])
        .join(items, "item")
    )

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            digest, item, shifts, segment, codes = (batch.column(i) for i in range(5))
            best = [
                (best_overlap(np.frombuffer(c.as_py(), np.uint64), np.frombuffer(s.as_py(), np.uint64), sorted(d.as_py())), len(c.as_py()) // 8)
                for d, s, c in zip(shifts, segment, codes)
            ]
            keep = pa.array([b >= window_of(n)[1] for b, n in best], pa.bool_())
            out = pa.RecordBatch.from_arrays(
                [
                    digest,
                    item,
                    pa.array([b for b, _ in best], pa.int64()),
                    pa.array([window_of(n)[0] for _, n in best], pa.int64()),
                ],
                names=["digest", "item", "n_equal", "n_window"],
            )
            yield out.filter(keep)

    verified = (
        aligned.select("digest", "item", "shifts", "segment", "codes")
        .mapInArrow(run, "digest binary, item long, n_equal long, n_window long")
        .groupBy("digest", "item")
        .agg(F.max("n_equal").alias("n_equal"), F.max("n_window").alias("n_window"))
    )
    named = _item_names(benchmark)
    return (
        found.select("doc_id", "digest")
        .distinct()
        .join(verified, "digest")
        .join(named, "item")
        .groupBy("doc_id", "item_id")
        .agg(F.max("n_equal").alias("n_equal"), F.max("n_window").alias("n_window"))
    )


def _item_names(benchmark: DataFrame) -> DataFrame:
    """item (the number of its text) and item_id."""

    def run(batches):
        codes = _Codes()
        for batch in batches:
            numbers = [
                xxhash.xxh3_64_intdigest(word_codes(v.as_py(), codes).tobytes()) >> 1 for v in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(numbers, pa.int64())], names=["item_id", "item"])

    kind = dict(benchmark.dtypes)["item_id"]
    return benchmark.select("item_id", utf8("text").alias("text")).mapInArrow(run, f"item_id {kind}, item long").distinct()


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text overlaps with no item.

    The verdict belongs to the text, so an id that stands for several texts loses
    only the contaminated ones. Null and empty texts stay.
    """
    key = F.xxhash64(F.md5(utf8(text)))
    bad = overlaps(docs.select(key.alias("key"), F.col(text).alias("text")), benchmark, "key", "text")
    bad = bad.select(F.col("doc_id").alias("bad")).distinct()
    keyed = docs.select(F.struct("*").alias("row"), key.alias("key"))
    return keyed.join(bad, F.col("key") == F.col("bad"), "left_anti").select("row.*")
