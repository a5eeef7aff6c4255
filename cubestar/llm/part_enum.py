"""Jaccard self-join of shingle sets by PartEnum signatures.

Two sets link when 100 * intersection >= 90 * union. That is the same as a number
of differing shingles of at most (sum of sizes) / 19, so sets of one size band
differ in at most a number k that the band fixes. Signatures of a band:

* The domain of shingle hashes is cut into ``n1`` partitions, so many that one of
  them holds at most ``LEFT_OUT`` of any k differences, and each partition into
  ``PARTS`` parts.
* For every partition each subset of ``PARTS - LEFT_OUT`` parts is enumerated; the
  shingles in them are one signature. A partition with at most ``LEFT_OUT``
  differences has a subset of parts without any, so two sets that link share a
  signature. A set goes to its own band and, if it is large enough to link with
  sets of the next one, to that as well.

Equal sets are one class. Groups of classes that share a signature are checked in
two steps, and never all their pairs: each class first with the smallest of its
group; then, in groups that still hold several components, across components: what the
sketches let pass falls into clusters, in which, block by block, a link joins two
components and no further pair of them is looked at.
Before shingles are compared, a parity sketch is: every shingle flips one of its
bits, so it never differs in more bits than the sets do in shingles.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubestar.llm.common import map_batches, utf8
from cubestar.llm.components import connected_components
from cubestar.llm.decontaminate import BITMAP_BITS, _bitmap
from cubestar.llm.words import WordHashes, mixed, shingle_set
from cubestar.sources.workdir import stage

SHINGLE_WORDS = 3
#: Differences that two sets that link may have: (sum of sizes) // REACH, which is
#: 100 * intersection >= 90 * union put in terms of differences.
REACH = 19
PARTS, LEFT_OUT = 3, 1
#: Smaller sets link with equal sets only: no two of them may differ by one.
LEAST = 9
#: Classes, and shingles, of one block of a large group.
BLOCK, BLOCK_SHINGLES = 1_024, 1 << 20

_hashes = WordHashes()


@cache
def bands(at_least: int) -> list[int]:
    """Smallest sizes of the bands up to that of ``at_least``; the next half as large again."""
    starts = [LEAST + 1]
    while starts[-1] <= at_least:
        starts.append(starts[-1] * 3 // 2)
    return starts


@cache
def _scheme(band: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(n1, ends of the parts in the domain of hashes, a salt for every signature)."""
    largest = bands(1 << 40)[band + 1] - 1
    k = 2 * largest // REACH
    n1 = -(-(k + 1) // (LEFT_OUT + 1))
    cells = n1 * PARTS
    ends = np.array([(c << 64) // cells for c in range(1, cells)], np.uint64)
    return n1, ends, mixed(np.arange(cells, dtype=np.uint64) + np.uint64((band + 1) << 40))


def bands_of(size: int) -> list[int]:
    """The own band of a set of that size and the next one, if it may link there."""
    starts = bands(1 << 40)
    own = int(np.searchsorted(starts, size, "right")) - 1
    found = [own] if own >= 0 else []
    # The smaller of two sets that link has 90 in 100 of the other's shingles.
    if 100 * size >= 90 * starts[own + 1]:
        found.append(own + 1)
    return found


def signatures(shingles: np.ndarray) -> np.ndarray:
    """Signatures of a set of ascending hashes; none for sets below ``LEAST``."""
    found = [np.zeros(0, np.uint64)]
    if len(shingles) >= LEAST:
        sums = np.zeros(len(shingles) + 1, np.uint64)
        np.cumsum(mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1:])
        for band in bands_of(len(shingles)):
            n1, ends, salts = _scheme(band)
            at = np.searchsorted(shingles, ends)
            cells = np.diff(sums[at], prepend=np.uint64(0), append=sums[-1]).reshape(n1, PARTS)
            # All parts but one, for each part and partition.
            subsets = cells.sum(axis=1, dtype=np.uint64)[:, None] - cells
            found.append(mixed(subsets.reshape(-1) + salts))
    return np.concatenate(found)


def sketch(shingles: np.ndarray) -> bytes:
    """Parities of the shingles by their lowest bits; wider for larger sets."""
    bits = 64
    while bits < 16 * len(shingles) // REACH:
        bits *= 2
    flips = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    """Sketches (rows of 64-bit words) as those of fewer bits."""
    while words.shape[1] > width:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


def _sketches_of(column: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Width in 64-bit words -> (rows, sketches)."""
    widths = np.array([len(s) // 8 for s in column])
    return {
        w: (rows := np.flatnonzero(widths == w), np.frombuffer(b"".join(column[r] for r in rows), np.uint64).reshape(-1, w))
        for w in np.unique(widths).tolist()
    }


def shingle_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, s1, s2 (a 128-bit name of the set), n, sketch, sigs of every row."""

    def step():
        def run(batch):
            s1, s2, n, sketches, sigs = [], [], [], [], []
            for value in batch.column(1):
                shingles = shingle_set(_hashes.of(value.as_py()), SHINGLE_WORDS)
                a, b = _name(shingles)
                s1.append(a)
                s2.append(b)
                n.append(len(shingles))
                sketches.append(sketch(shingles))
                sigs.append(signatures(shingles))
            ends = np.cumsum([0, *map(len, sigs)]).astype(np.int32)
            flat = np.concatenate(sigs).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(n, pa.int64()),
                    pa.array(sketches, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                names=["doc_id", "s1", "s2", "n", "sketch", "sigs"],
            )

        return run

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(text).alias("text"))
    return map_batches(rows, step, "doc_id long, s1 long, s2 long, n long, sketch binary, sigs array<long>")


def _name(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set: two sums of unlike hashes of its shingles."""
    first = mixed(shingles ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64)
    second = mixed(shingles ^ np.uint64(0xDA942042E4DD58B5)).sum(dtype=np.uint64)
    return tuple(np.array([first, second], np.uint64).view(np.int64).tolist())


def _near(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that may link by their sizes and sketches."""
    left = classes.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = classes.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    reach = F.floor((F.col("na") + F.col("nb")) / REACH)
    joined = pairs.join(left, "a").join(right, "b").where(F.abs(F.col("na") - F.col("nb")) <= reach)

    def step():
        def run(batch):
            a, b, na, sa, nb, sb = batch.columns
            held = np.zeros(batch.num_rows, bool)
            reach = (na.to_numpy() + nb.to_numpy()) // REACH
            by_right = _sketches_of(sb.to_pylist())
            for wa, (rows_a, words_a) in _sketches_of(sa.to_pylist()).items():
                for wb, (rows_b, words_b) in by_right.items():
                    both, at_a, at_b = np.intersect1d(rows_a, rows_b, return_indices=True)
                    if len(both):
                        w = min(wa, wb)
                        xor = _folded(words_a[at_a], w) ^ _folded(words_b[at_b], w)
                        held[both] = np.bitwise_count(xor).sum(axis=1) <= reach[both]
            return pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(held))

        return run

    return map_batches(joined.select("a", "b", "na", "sa", "nb", "sb"), step, "a long, b long")


def _sets_of(ids: DataFrame, classes: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, shingles (ascending hashes as bytes) of the classes in ``ids``.

    Only the texts that may be wanted are cut into shingles again: a bitmap of fixed
    size holds the ids of a document of each class.
    """
    wanted = classes.select("id", "s1", "s2", "doc_id").join(ids.distinct(), "id")
    key = F.xxhash64(F.col("doc_id").cast("long"))
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted.select(key.alias("hash"))))

    def run(batches):
        bits = shared.value
        for batch in batches:
            slots = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - BITMAP_BITS)
            out = []
            for row in np.flatnonzero(bits[slots]).tolist():
                shingles = shingle_set(_hashes.of(batch.column(1)[row].as_py()), SHINGLE_WORDS)
                out.append((*_name(shingles), shingles.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else ([], [], []), (pa.int64(), pa.int64(), pa.binary()))],
                names=["s1", "s2", "shingles"],
            )

    texts = docs.select(F.xxhash64(F.col(doc_id).cast("long")).alias("key"), utf8(text).alias("text"))
    again = texts.mapInArrow(run, "s1 long, s2 long, shingles binary")
    return stage(
        again.join(wanted.select("id", "s1", "s2"), ["s1", "s2"])
        .groupBy("id")
        .agg(F.first("shingles").alias("shingles")),
        "sets",
    )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link, by their shingles."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b"
    )

    def step():
        def run(batch):
            held = []
            for left, right in zip(batch.column(2), batch.column(3)):
                left, right = (np.frombuffer(x.as_buffer(), np.uint64) for x in (left, right))
                shared = len(np.intersect1d(left, right, assume_unique=True))
                held.append(100 * shared >= 90 * (len(left) + len(right) - shared))
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                pa.array(held, pa.bool_())
            )

        return run

    return map_batches(both.select("a", "b", "sa", "sb"), step, "a long, b long")


def _dealt(members: DataFrame, classes: DataFrame, group: str, block: int) -> DataFrame:
    """key, id, root, n, sketch of members of groups that hold several components.

    ``members`` has the group's column, id and root. Large groups are dealt as pairs of
    blocks; a key is a group or a pair of its blocks.
    """
    sized = members.join(classes.select("id", "n", "sketch"), "id")
    groups = sized.groupBy(group).agg(
        F.count("*").alias("held"), F.sum("n").alias("shingles"), F.min("root").alias("lo"), F.max("root").alias("hi")
    )
    blocks = F.ceil(F.greatest(F.col("held") / block, F.col("shingles") / BLOCK_SHINGLES))
    rows = sized.join(groups.where("lo < hi").select(group, blocks.alias("blocks")), group)
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    dealt = rows.select(
        group, "id", "root", "n", "sketch", own.alias("own"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"),
    )
    key = F.xxhash64(group, F.least("own", "other"), F.greatest("own", "other"))
    return dealt.select(key.alias("key"), "id", "root", "n", "sketch")


def group_links(ids, roots, n, sketches: list[bytes], sets: list[bytes] | None = None):
    """(id, id) links inside a group, fewer than it has members.

    With ``sets`` sketches come first and the shingles decide. Members of one component
    are not compared, and a component that a link has joined counts as the other from
    there on. Without sets a pair of different components that the sketches let pass
    is a link, and members that such links connect already are not compared.
    """
    nodes = roots if sets is not None else np.arange(len(ids))
    parent = {r: r for r in set(nodes.tolist())}

    def find(r):
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r

    shingles = [np.frombuffer(s, np.uint64) for s in sets or ()]
    # Rows of one width of sketch, narrower ones with folded wider ones.
    widths = sorted(_sketches_of(sketches).items())
    for at, (width, (rows_a, words_a)) in enumerate(widths):
        for _, (rows_b, words_b) in widths[at:]:
            folded = _folded(words_b, width)
            now = np.array([find(r) for r in nodes[rows_b].tolist()])
            for row, words in zip(rows_a.tolist(), words_a):
                mine = find(int(nodes[row]))
                open_ = (now != mine) & (roots[rows_b] != roots[row]) & (np.abs(n[rows_b] - n[row]) <= (n[rows_b] + n[row]) // REACH)
                some = np.flatnonzero(open_ & (rows_b > row) if rows_a is rows_b else open_)
                if not len(some):
                    continue
                bits = np.bitwise_count(folded[some] ^ words).sum(axis=1)
                some = some[bits <= (n[rows_b[some]] + n[row]) // REACH]
                if not len(some):
                    continue
                near = rows_b[some]
                linked = np.ones(len(near), bool)
                if sets is not None:
                    both = np.concatenate([shingles[r] for r in near.tolist()])
                    spot = np.minimum(np.searchsorted(shingles[row], both), len(shingles[row]) - 1)
                    ends = np.cumsum(n[near])
                    shared = np.diff(np.cumsum(shingles[row][spot] == both)[ends - 1], prepend=0)
                    linked = 100 * shared >= 90 * (n[near] + n[row] - shared)
                for other in near[linked].tolist():
                    theirs = find(int(nodes[other]))
                    mine = find(mine)
                    if theirs != mine:
                        parent[theirs] = mine
                        yield int(ids[row]), int(ids[other])
                if linked.any():
                    now = np.array([find(r) for r in now.tolist()])


def _links_inside(rows: DataFrame) -> DataFrame:
    """a, b: links of ``group_links`` for every key of the rows, with sets if they have any."""
    n_parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_values = len(rows.columns) - 1

    def run(batches):
        held: list[list] = [[] for _ in range(n_values)]
        key = None

        def links():
            ids, roots, n = (np.array(c, np.int64) for c in held[:3])
            found = list(group_links(ids, roots, n, *held[3:]))
            a, b = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for k, *values in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key:
                    if key is not None:
                        yield links()
                    held, key = [[] for _ in range(n_values)], k
                for column, value in zip(held, values):
                    column.append(value)
        if key is not None:
            yield links()

    sorted_rows = rows.repartition(n_parts, "key").sortWithinPartitions("key")
    return sorted_rows.mapInArrow(run, "a long, b long").distinct()


def similar_sets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Words are cut at ASCII blanks with A-Z lowered; a text of fewer than
    ``SHINGLE_WORDS`` words is one shingle. Null and empty texts, and those of blanks
    only, have no shingle, link with nothing and are components of their own. Equal
    sets link. The component id is the smallest id that links reach. Rows with a null
    id take part; a component without another id has a null id. Repeated rows are
    returned each; other columns are ignored. Shingles are compared by 64-bit hashes.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stage(shingle_rows(docs, doc_id, text), "shingle-rows")
    classes = stage(
        rows.where("n > 0")
        .groupBy("s1", "s2")
        .agg(
            F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
            F.first("sketch").alias("sketch"), F.first("sigs").alias("sigs"),
        )
        .withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    slim = classes.drop("sigs")
    # Counted and joined from one exchange.
    entries = classes.select("id", F.explode("sigs").alias("sig")).repartition(n, "sig")
    groups = (
        entries.groupBy("sig")
        .agg(
            F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("held"),
            F.bit_xor(F.xxhash64("id")).alias("who"),
        )
        .where("lo < hi")
        .groupBy("lo", "hi", "held", "who")  # groups of the same classes once
        .agg(F.min("sig").alias("sig"))
    )
    groups = stage(groups.select("sig", "lo", "hi", "held"), "groups")
    members = stage(entries.join(groups.where("held > 2").select("sig", "lo"), "sig").where("id <> lo"), "members")
    hubs = members.select(F.col("id").alias("a"), F.col("lo").alias("b")).unionByName(
        groups.where("held = 2").select(F.col("hi").alias("a"), F.col("lo").alias("b"))
    )
    near = stage(_near(hubs.distinct(), slim), "near")
    ends = near.select(F.explode(F.array("a", "b")).alias("id"))
    links = stage(_verified(near, _sets_of(ends, slim, docs, doc_id, text)), "links")
    # Classes with one label are surely of one component: they lead to the same class
    # over one or two links. That spares most comparisons; the components follow last.
    step = links.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("hub"))
    further = step.select(F.col("id").alias("hub"), F.col("hub").alias("beyond"))
    labels = stage(
        step.join(further, "hub", "left").select("id", F.coalesce("beyond", "hub").alias("root")), "labels"
    )
    labelled = members.select("sig", "id").join(labels, "id", "left").select(
        "sig", "id", F.coalesce("root", "id").alias("root")
    )
    # What may link across components, by sketches, falls into clusters: every class is
    # in one of them, so its shingles are read once, however many groups it is in.
    may_link = stage(_links_inside(_dealt(labelled, slim, "sig", block)), "may-link")
    if not may_link.isEmpty():
        clusters = stage(connected_components(may_link), "clusters")
        clustered = clusters.select(F.col("node").alias("id"), F.col("root").alias("cluster")).join(
            labels, "id", "left"
        ).select("cluster", "id", F.coalesce("root", "id").alias("root"))
        sets = _sets_of(clustered.select("id"), slim, docs, doc_id, text)
        more = _links_inside(_dealt(clustered, slim, "cluster", block).join(sets, "id").select(
            "key", "id", "root", "n", "sketch", "shingles"
        ))
        links = stage(links.unionByName(more), "links")
    roots = stage(connected_components(links), "roots")
    named = slim.join(roots.withColumnRenamed("node", "id"), "id", "left").select(
        "s1", "s2", "doc_id", F.coalesce("root", "id").alias("root")
    )
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_set = named.select("s1", "s2", "root").join(least, "root").select("s1", "s2", "component_id")
    sets = rows.where("n > 0").select("doc_id", "s1", "s2", F.col("n").alias("n_shingles"))
    linked = sets.join(of_set, ["s1", "s2"]).select("doc_id", "n_shingles", "component_id")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
