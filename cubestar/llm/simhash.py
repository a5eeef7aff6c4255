"""SimHash near duplicates by a byte-position index with count filtering.

Two fingerprints that differ in at most ``MAX_BITS`` bits differ in at most as
many of their eight bytes, so they share at least ``8 - MAX_BITS`` bytes at equal
positions. The index is keyed by the bytes at ``KEY_BYTES`` positions at once,
for a family of position sets of which any four positions hold one whole: each
pair that reaches the minimum meets in some posting. Inside a posting the shared
positional bytes of a pair are tallied, pairs below the minimum are dropped and
the rest verified. A posting yields links to the smallest member of each linked
group and never its pairs.

Equal fingerprints are one entry. Postings of more than ``BLOCK`` entries are
dealt out as pairs of blocks. Beyond ``MAX_BLOCKS`` blocks, entries meet in all
values within two bits of them instead: two entries have such a value in common
exactly if they differ in at most four bits, at a cost per entry that is constant.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubestar.llm.common import map_batches, utf8
from cubestar.llm.components import connected_components
from cubestar.sources.workdir import stage

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
MIN_SHARED = 8 - MAX_BITS
KEY_BYTES = 3
BLOCK = 1024
MAX_BLOCKS = 128


def position_sets(n: int = 8, inside: int = MIN_SHARED, size: int = KEY_BYTES) -> list[tuple[int, ...]]:
    """Sets of ``size`` positions so that any ``inside`` positions hold one whole.

    Three cyclic groups of positions: a set lies in one group, or has two
    positions in a group and one in the next. The property is verified.
    """
    groups = [list(range(g, n, 3)) for g in range(3)]
    found = [s for g in groups for s in combinations(g, 3)]
    for g, following in zip(groups, groups[1:] + groups[:1]):
        found += [(*pair, other) for pair in combinations(g, 2) for other in following]
    sets = sorted(tuple(sorted(s)) for s in found)
    covered = all(any(set(s) <= set(held) for s in sets) for held in combinations(range(n), inside))
    if size != 3 or not covered:
        raise ValueError("the position sets do not meet every pair")
    return sets


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text over its shingles, as an unsigned number."""
    words = text.lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = (starts + lengths)[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends.tolist())), np.uint64, n
    )
    total = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    ones = np.packbits(2 * total > n, bitorder="little")
    return int(ones.view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, tag, fp (signed long) of every row; a null text is empty.

    The tag is a hash of the text, for telling rows of one id apart.
    """

    def step():
        def run(batch):
            values = np.fromiter((fingerprint(t.as_py()) for t in batch.column(2)), np.uint64, batch.num_rows)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values.view(np.int64))],
                names=["doc_id", "tag", "fp"],
            )

        return run

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), _tag(text).alias("tag"), utf8(text).alias("text")
    )
    return map_batches(rows, step, "doc_id long, tag long, fp long")


def _tag(text: str) -> F.Column:
    return F.xxhash64(utf8(text))


def _linked(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs share enough positional bytes and then differ in few bits."""
    xor = left ^ right
    shared = (xor.view(np.uint8).reshape(*xor.shape, 8) == 0).sum(axis=-1)
    return (shared >= MIN_SHARED) & (np.bitwise_count(xor) <= MAX_BITS)


def group_links(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """(entry, smallest entry) for the linked groups among at most 2 * BLOCK entries."""
    values = np.unique(values)
    unseen = np.ones(len(values), bool)
    for start in range(len(values)):
        if not unseen[start]:
            continue
        unseen[start] = False
        stack = [start]
        while stack:
            at = stack.pop()
            rest = np.flatnonzero(unseen)
            near = rest[_linked(values[rest], values[at])]
            unseen[near] = False
            stack += near.tolist()
            for other in near.tolist():
                yield values[other], values[start]


def _posting_links(postings: DataFrame) -> DataFrame:
    """a, b for lists of entries; lists of equal length are handled together."""

    def step():
        def run(batch):
            lists = batch.column(0)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            sizes = np.diff(ends, prepend=0)
            a, b = [], []
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                if size <= 8:
                    held = flat[(ends[rows] - size)[:, None] + np.arange(size)]
                    for i, j in combinations(range(size), 2):
                        hit = _linked(held[:, i], held[:, j])
                        a.append(held[hit, i])
                        b.append(held[hit, j])
                else:
                    for end in ends[rows].tolist():
                        links = list(group_links(flat[end - size : end]))
                        a.append(np.array([x for x, _ in links], np.uint64))
                        b.append(np.array([x for _, x in links], np.uint64))
            merged = [np.concatenate(x).astype(np.uint64).view(np.int64) if x else np.zeros(0, np.int64) for x in (a, b)]
            return pa.RecordBatch.from_arrays([pa.array(m) for m in merged], names=["a", "b"])

        return run

    return map_batches(postings.select("entries"), step, "a long, b long")


def _near_values(entries: DataFrame) -> DataFrame:
    """value, fp: every value within two bits of an entry."""
    masks = [0] + [1 << i for i in range(64)] + [1 << i | 1 << j for i, j in combinations(range(64), 2)]
    masks = np.array(masks, np.uint64)

    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), 64):
                own = fps[at : at + 64]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((own[:, None] ^ masks).reshape(-1).view(np.int64)),
                        pa.array(np.repeat(own, len(masks)).view(np.int64)),
                    ],
                    names=["value", "fp"],
                )

    return entries.select("fp").mapInArrow(run, "value long, fp long")


def links(entries: DataFrame, block: int = BLOCK, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """a, b: links whose components are those of all pairs within ``MAX_BITS`` bits.

    ``entries`` holds distinct fingerprints in fp.
    """
    sets = position_sets()
    byte = lambda p: F.shiftright("fp", 8 * p).bitwiseAND(F.lit(255))
    key = lambda s: sum((byte(p) * (1 << 8 * k) for k, p in enumerate(s)), F.lit(0))
    keyed = entries.select(
        "fp",
        F.explode(F.array(*[(key(s) + (n << 8 * KEY_BYTES)).cast("long") for n, s in enumerate(sets)])).alias("key"),
    )
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    held = stage(
        keyed.join(sizes, "key").withColumn("blocks", F.ceil(F.col("n") / block).cast("long")), "postings"
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    # Entries of block i go to the pairs (i, j) and (j, i) of blocks, smaller first.
    dealt = held.where(F.col("blocks") <= max_blocks).select(
        "key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    )
    postings = dealt.groupBy("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).agg(
        F.collect_list("fp").alias("entries")
    ).where(F.size("entries") > 1)
    found = _posting_links(postings)
    crowded = held.where(F.col("blocks") > max_blocks).select("fp").distinct()
    if not crowded.isEmpty():
        near = stage(_near_values(crowded), "near-values")
        hubs = near.groupBy("value").agg(F.min("fp").alias("hub"))
        found = found.unionByName(
            near.join(hubs, "value").where("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b"))
        )
    return found.distinct()


def _classes(rows: DataFrame, least: F.Column) -> DataFrame:
    """fp, least: the smallest value of the column in each fingerprint's component."""
    entries = stage(rows.groupBy("fp").agg(F.min(least).alias("least")), "entries")
    roots = connected_components(links(entries))
    labelled = entries.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    return labelled.select("fp", "root").join(
        labelled.groupBy("root").agg(F.min("least").alias("least")), "root"
    ).select("fp", "least")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id of every row.

    The component id is the smallest id that links of at most ``MAX_BITS`` bits
    reach. Null and empty texts have fingerprint zero and link like any other.
    Rows with a null id take part; where a component has no other id, its id is
    null. Repeated rows are returned each; other columns are ignored.
    """
    rows = stage(fingerprints(docs, doc_id, text).drop("tag"), "fingerprints")
    return rows.join(_classes(rows, F.col("doc_id")), "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least").alias("component_id"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with all its columns.

    It is the row with the smallest id (null ids last), of several texts under
    that id the one with the smallest hash, and of repeated rows any one.
    """
    rows = stage(fingerprints(docs, doc_id, text), "fingerprints")
    least = F.struct(F.col("doc_id").isNull(), "doc_id", "tag")
    named = rows.join(_classes(rows, least), "fp")
    others = named.where(~(F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("tag") == F.col("least.tag"))))
    dropped = others.select(F.col("doc_id").alias("_id"), F.col("tag").alias("_other")).distinct()
    tagged = docs.select(
        F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("id"), _tag(text).alias("tag")
    )
    kept = tagged.join(
        dropped, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_other")), "left_anti"
    )
    if not rows.groupBy("doc_id", "tag").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        kept = kept.dropDuplicates(["id", "tag"])
    return kept.select("row.*")
