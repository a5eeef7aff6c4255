"""The trie of conversation prefixes, by collapse of whole sequences.

Identical conversations are grouped into one weighted sequence with the list of
conversations that end there. Only distinct sequences are walked: their prefixes
are grouped into nodes by weight, a sequence that is a proper prefix of another is
dropped by an anti join, so what is left are the leaves, and subtree totals are
sums along the sequences that are aggregated by node again. A node's text counts
once, for the sequence that holds its smallest conversation: that sequence holds
the smallest one of every deeper node on its way too.

Turns travel as two 64-bit hashes and a length; a prefix is the exclusive or of
hashes that hold the place, so it needs no text and no order of evaluation. No
step gathers a conversation: turns are numbered within ranges of the sorted rows,
and running totals are taken in blocks of ``BLOCK`` turns, whose totals meet.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubestar.sources.workdir import stage

BLOCK = 256
#: Conversations of one hundred share the first turns of the first of them.
FAMILY = 100
#: At most so many turns, less one, are shared.
SHARED = 6

_NODE = ("depth", "p1", "p2")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), h1, h2, chars of every row that has a conversation.

    Rows are ordered by turn (null first), equal turns by role, then text; a null
    role or text is empty. Rows without a conv_id belong to no conversation.
    """
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = ["conv_id", "turn", "role"]
    # Ranges go by the start of a role, so that their bounds are short.
    spread = rows.repartitionByRange(n, "conv_id", "turn", F.substring("role", 1, 64))
    slim = spread.sortWithinPartitions(*order, "text").select(
        "conv_id",
        F.monotonically_increasing_id().alias("seq"),
        F.xxhash64("role", "text").alias("h1"),
        F.xxhash64(F.lit(1), "text", "role").alias("h2"),
        F.length("text").cast("long").alias("chars"),
    )
    rows = stage(slim, "turns").withColumn("part", F.shiftright("seq", 33))
    # A conversation may span ranges: its rows before a range are counted.
    runs = rows.groupBy("conv_id", "part").agg(F.min("seq").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return rows.join(runs, ["conv_id", "part"]).select(
        "conv_id", (F.col("seq") - F.col("first") + F.col("before")).alias("pos"), "h1", "h2", "chars"
    )


def with_shared_turns(turns: DataFrame) -> DataFrame:
    """Every conversation with its first turns taken from the first of its family.

    Conversation c takes the first h turns of conversation c - c % FAMILY (all if
    that has fewer, none if there is none), then its own after its first h; h is
    the unsigned crc32 of its decimal id modulo ``SHARED``.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % SHARED
    family = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family")
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < SHARED - 1))
    held = heads.groupBy(F.col("conv_id").alias("family")).agg(F.count("*").alias("held"))
    own = (
        turns.select("*", h.alias("h"), family)
        .where("pos >= h")
        .join(held, "family", "left")
        .select(
            "conv_id",
            (F.col("pos") - F.col("h") + F.least("h", F.coalesce("held", F.lit(0)))).alias("pos"),
            "h1", "h2", "chars",
        )
    )
    members = turns.where("pos = 0").select("conv_id", h.alias("h"), family)
    shared = members.join(heads.withColumnRenamed("conv_id", "family"), "family").where("pos < h")
    return own.unionByName(shared.select("conv_id", "pos", "h1", "h2", "chars"))


def _running(rows: DataFrame, key: str, at: str, totals: dict[str, tuple[str, str]], down: bool = False) -> DataFrame:
    """Rows with running totals by key: name -> (aggregate, column), own row included.

    Blocks of positions are totalled first, so that a very long key is spread.
    """
    rows = rows.withColumn("block", F.floor(F.col(at) / BLOCK))
    order = (lambda c: F.col(c).desc()) if down else F.col
    inner = Window.partitionBy(key, "block").orderBy(order(at)).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(key).orderBy(order("block")).rowsBetween(Window.unboundedPreceding, -1)
    agg = {"sum": F.sum, "xor": F.bit_xor}
    blocks = rows.groupBy(key, "block").agg(*[agg[f](c).alias(f"{n}_block") for n, (f, c) in totals.items()])
    before = blocks.select(
        key, "block",
        *[F.coalesce(agg[f](f"{n}_block").over(outer), F.lit(0)).alias(f"{n}_before") for n, (f, c) in totals.items()],
    )
    inside = rows.select("*", *[agg[f](c).over(inner).alias(f"{n}_inside") for n, (f, c) in totals.items()])
    joined = inside.join(before, [key, "block"])
    whole = {
        n: F.col(f"{n}_inside") + F.col(f"{n}_before") if f == "sum"
        else F.col(f"{n}_inside").bitwiseXOR(F.col(f"{n}_before"))
        for n, (f, c) in totals.items()
    }
    return joined.select(*rows.drop("block").columns, *[c.alias(n) for n, c in whole.items()])


def _ends(sequences: DataFrame) -> DataFrame:
    """k1, k2, depth, ends_sha256: digest of each sequence's ids in order, comma-joined.

    Ids arrive sorted and are hashed as they come, so no list of them is held.
    """
    n = int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        key, digest = None, None

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int64()) for k in key] + [pa.array([digest.hexdigest()])],
                names=["k1", "k2", "depth", "ends_sha256"],
            )

        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(3)]
            ids = batch.column(3).to_pylist()
            if not ids:
                continue
            change = np.zeros(len(ids), bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                now = tuple(int(c[a]) for c in columns)
                listed = ",".join(map(str, ids[a:b])).encode()
                if now == key:
                    digest.update(b"," + listed)
                    continue
                if key is not None:
                    yield done()
                key, digest = now, hashlib.sha256(listed)
        if key is not None:
            yield done()

    keys = ["k1", "k2", "depth"]
    spread = sequences.select(*keys, "conv_id").repartition(n, *keys).sortWithinPartitions(*keys, "conv_id")
    return spread.mapInArrow(run, "k1 long, k2 long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations.

    ``turns`` has conv_id, pos (from 0, without gaps), h1, h2 and chars; ``ids`` has
    every conv_id once, those without turns too. Returns conv_id (smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over the
    subtree, for each node its other members times the length of its last text) and
    ends_sha256 (of the ids that end at the node). Without conversations there is no
    node, not even the root.
    """
    hashed = turns.select(
        "conv_id", "pos", "chars",
        F.xxhash64("pos", "h1", "h2").alias("e1"),
        F.xxhash64("h2", "pos", "h1", F.lit(2)).alias("e2"),
    )
    whole = hashed.groupBy("conv_id").agg(
        F.bit_xor("e1").alias("k1"), F.bit_xor("e2").alias("k2"), F.count("*").alias("depth")
    )
    conversations = stage(ids.select("conv_id").join(whole, "conv_id", "left").na.fill(0), "sequences-of")
    # One weighted sequence for all conversations that are the same.
    sequences = stage(
        conversations.groupBy("k1", "k2", "depth").agg(
            F.count("*").alias("weight"), F.min("conv_id").alias("seq")
        ),
        "sequences",
    )
    walked = hashed.join(sequences.select(F.col("seq").alias("conv_id"), "weight"), "conv_id").select(
        F.col("conv_id").alias("seq"), "pos", "chars", "weight", "e1", "e2"
    )
    prefixes = stage(
        _running(walked, "seq", "pos", {"p1": ("xor", "e1"), "p2": ("xor", "e2")}).select(
            "seq", "weight", "chars", (F.col("pos") + 1).alias("depth"), "p1", "p2",
            F.col("p1").bitwiseXOR(F.col("e1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("e2")).alias("q2"),
        ),
        "prefixes",
    )
    nodes = stage(
        prefixes.groupBy(*_NODE).agg(
            F.sum("weight").alias("n_convs"), F.min("seq").alias("conv_id"), F.min("chars").alias("chars"),
            F.min("q1").alias("q1"), F.min("q2").alias("q2"),
        ),
        "nodes",
    )
    parents = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
        F.count("*").alias("n_children")
    )
    # Leaves: sequences that are no proper prefix of another.
    leaves = sequences.join(
        parents.select("depth", F.col("p1").alias("k1"), F.col("p2").alias("k2")), ["depth", "k1", "k2"], "left_anti"
    ).select("seq", F.lit(1).cast("long").alias("leaf"))
    leaves = stage(leaves, "leaves")
    owned = F.when(F.col("seq") == F.col("conv_id"), F.col("chars")).otherwise(0)
    saved = prefixes.join(nodes.select(*_NODE, "conv_id"), list(_NODE)).select(
        *_NODE, "seq", (F.col("weight") * F.col("chars") - owned).alias("own")
    )
    below = _running(saved, "seq", "depth", {"saved": ("sum", "own")}, down=True).join(leaves, "seq", "left")
    totals = below.groupBy(*_NODE).agg(
        F.sum("saved").alias("saved_tokens"), F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves")
    )
    # The root is a single row of five numbers: its totals are those of all nodes.
    spark = turns.sparkSession
    n_convs, smallest = conversations.agg(F.count("*"), F.min("conv_id")).first()
    all_saved = nodes.agg(F.coalesce(F.sum(F.expr("(n_convs - 1) * chars")), F.lit(0))).first()[0]
    root = spark.createDataFrame(
        [(0, 0, 0, smallest, None, n_convs, all_saved, leaves.count())] if n_convs else [],
        "depth long, p1 long, p2 long, conv_id long, parent_conv_id long, n_convs long,"
        " saved_tokens long, n_leaves long",
    )
    above = nodes.where("depth > 1").join(
        nodes.select(
            (F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
            F.col("conv_id").alias("parent_conv_id"),
        ),
        ["depth", "q1", "q2"],
    )
    top = nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(smallest).cast("long"))
    columns = [*_NODE, "conv_id", "parent_conv_id", "n_convs"]
    placed = above.select(*columns).unionByName(top.select(*columns)).join(totals, list(_NODE))
    placed = placed.unionByName(root)
    ends = _ends(conversations).withColumnsRenamed({"k1": "p1", "k2": "p2"})
    return (
        placed.join(parents, list(_NODE), "left")
        .join(ends, list(_NODE), "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations that share the first turns of their family.

    Order, nulls and ties as in ``numbered_turns``, sharing as in
    ``with_shared_turns``; repeated rows are turns of their own, other columns are
    ignored, and an empty table has no nodes.
    """
    turns = stage(numbered_turns(conversations), "numbered")
    rebuilt = stage(with_shared_turns(turns), "rebuilt")
    return prefix_trie(rebuilt, turns.where("pos = 0").select("conv_id"))
