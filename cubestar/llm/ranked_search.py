"""Ranked lexical search by buckets of impact vectors.

A document's impact vector holds, for each term that some item asks for, what the
term would add to a score; an item is the set of its terms. Vectors are ordered by
length, longest first, and cut into buckets:

1. The longest vectors are scored against all items. An item's ``k``-th best score
   among them is a floor that every later document has to reach.
2. A bucket is skipped for an item where the Cauchy-Schwarz bound (root of the
   number of terms times the longest vector) or the sum of the bucket's largest
   coordinates is below the item's floor.
3. Inside a bucket only the item's largest coordinates are summed, as many as are
   needed so that the others alone can't reach the floor. A document stays if that
   sum and a bound of the rest (Cauchy-Schwarz on what is left of the vector, or
   the largest coordinates) reach it.
4. What stays is scored in integers and raises the floor.

Bounds are compared with a margin for rounding and ties stay, so the result is that
of scoring every document. Items are taken in blocks of at most about
``BLOCK_TERMS`` terms, so what is sent to the tasks is bounded.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubestar.llm.common import map_batches, utf8
from cubestar.llm.words import pieces
from cubestar.sources.workdir import stage

#: Terms of items, each item's counted, that one pass over the documents serves.
BLOCK_TERMS = 200_000
#: Vectors of one bucket.
BUCKET = 2_048
#: Longest vectors that give the first floors.
SEEDS = 4_096

#: Bytes of terms, A-Z lowered; all others part terms.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def term_counts(raw: bytes) -> tuple[int, Counter]:
    """Terms with repeats, and how often each occurs."""
    n, counts = 0, Counter()
    for piece in pieces(raw, lambda some: some.translate(_TERM_BYTES)):
        words = piece.split()
        n += len(words)
        counts.update(words)
    return n, counts


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, term (binary): the distinct terms of every item.

    Rows of one id (null is one, too) are one item. An item without terms is absent.
    """

    def step():
        def run(batch):
            ids, terms = [], []
            for number, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = term_counts(value.as_py())[1]
                ids += [number] * len(found)
                terms += found
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], names=["item_id", "term"]
            )

        return run

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), utf8(text).alias("text"))
    return map_batches(rows, step, "item_id long, term binary").distinct()


def _occurrences(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n, terms, counts: of every document the terms that items ask for."""

    def step():
        def run(batch):
            n, terms, counts, ends = [], [], [], [0]
            for value in batch.column(1):
                total, held = term_counts(value.as_py())
                wanted = [(vocabulary[t], c) for t, c in held.items() if t in vocabulary]
                n.append(total)
                terms += [t for t, _ in wanted]
                counts += [c for _, c in wanted]
                ends.append(len(terms))
            lists = [
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, t))
                for x, t in ((terms, pa.int32()), (counts, pa.int64()))
            ]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"]
            )

        return run

    rows = docs.select("doc_id", "text")
    return map_batches(rows, step, "doc_id long, n long, terms array<int>, counts array<long>")


class _Impacts:
    """Impact vectors of Arrow rows (doc_id, n, terms, counts)."""

    def __init__(self, weights: np.ndarray, n_docs: int, n_terms: int):
        self.weights, self.n_docs, self.n_terms = weights, n_docs, n_terms

    def of(self, n, terms, counts):
        """(row, term, impact) of every coordinate; terms and counts are list arrays."""
        sizes = terms.value_lengths().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)
        term = terms.flatten().to_numpy(zero_copy_only=False)
        tf = counts.flatten().to_numpy(zero_copy_only=False)
        norm = 100 - 90 + (90 * n.to_numpy(zero_copy_only=False) * self.n_docs) // self.n_terms
        impact = self.weights[term] * ((1_000_000_000 * tf) // (1_000 * tf + 8 * norm[row]))
        return row, term, impact


def _with_length(rows: DataFrame, impacts: _Impacts) -> DataFrame:
    """The rows and the length of their vectors; vectors of length zero are left out."""

    def step():
        def run(batch):
            row, _, impact = impacts.of(batch.column(1), batch.column(2), batch.column(3))
            squares = np.bincount(row, impact.astype(float) ** 2, batch.num_rows)
            full = pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.sqrt(squares))], names=[*batch.schema.names, "length"]
            )
            return full.filter(pa.array(squares > 0))

        return run

    return map_batches(rows, step, "doc_id long, n long, terms array<int>, counts array<long>, length double")


class _Best:
    """The k best documents of an item so far; equal scores by ascending id, null last."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor, self.rows = k, max(floor, 1), []

    def add(self, scores, ids) -> None:
        self.rows += [(-s, d is None, d or 0) for s, d in zip(scores, ids) if s >= self.floor]
        if len(self.rows) > self.k:
            self.rows = sorted(self.rows)[: self.k]
        if len(self.rows) == self.k:
            self.floor = max(self.floor, -max(self.rows)[0])


#: Bounds are sums of doubles; they may fall short of the truth by a little.
_MARGIN = 1 + 1e-9


def _bucket(best, items, flat, opens, row, term, impact, lengths, ids):
    """Bring the vectors of one bucket into the best of every item."""
    order = np.argsort(term, kind="stable")
    term_, row_, impact_ = term[order], row[order], impact[order]
    present, start = np.unique(term_, return_index=True)
    stop = np.append(start[1:], len(term_))
    largest = np.zeros(int(max(flat.max(initial=0), term_.max(initial=0))) + 1, np.int64)
    if len(present):
        largest[present] = np.maximum.reduceat(impact_, start)
    column = dict(zip(present.tolist(), zip(start.tolist(), stop.tolist())))
    # Step 2 for all items at once.
    sums = np.add.reduceat(largest[flat], opens)
    sizes = np.diff(np.append(opens, len(flat)))
    floors = np.array([b.floor for b in best])
    open_items = np.flatnonzero((sums >= floors) & (np.sqrt(sizes) * lengths.max() * _MARGIN >= floors))
    first = np.searchsorted(row, np.arange(len(lengths) + 1))
    wanted = np.zeros(len(largest), bool)
    for i in open_items.tolist():
        terms = items[i]
        tops = largest[terms]
        by_size = np.argsort(-tops, kind="stable")
        rest_of = np.cumsum(tops[by_size][::-1])[::-1] - tops[by_size]  # what is left behind each
        n_focus = int(np.searchsorted(-rest_of, -best[i].floor, side="right")) + 1
        focus, rest = terms[by_size[:n_focus]], int(rest_of[min(n_focus, len(terms)) - 1])
        partial = np.zeros(len(lengths), np.int64)
        squares = np.zeros(len(lengths))
        for t in focus.tolist():
            if t in column:
                a, b = column[t]
                partial[row_[a:b]] += impact_[a:b]
                squares[row_[a:b]] += impact_[a:b].astype(float) ** 2
        left = np.sqrt(np.maximum(lengths**2 * _MARGIN - squares, 0) * max(len(terms) - len(focus), 0))
        held = np.flatnonzero(
            (partial > 0) & ((partial + np.minimum(left * _MARGIN, rest)) * _MARGIN >= best[i].floor)
        )
        if not len(held):
            continue
        # Step 4: the whole score of what stays, in integers.
        wanted[terms] = True
        sizes_ = first[held + 1] - first[held]
        at = np.repeat(first[held] - np.cumsum(sizes_) + sizes_, sizes_) + np.arange(sizes_.sum())
        owner = np.repeat(np.arange(len(held)), sizes_)
        hit = wanted[term[at]]
        wanted[terms] = False
        scores = np.zeros(len(held), np.int64)
        np.add.at(scores, owner[hit], impact[at][hit])
        best[i].add(scores.tolist(), [ids[r] for r in held.tolist()])


def _rank(rows: DataFrame, impacts: _Impacts, items: list[np.ndarray], item_ids: list, k: int, floors: list[int]):
    """item_id, doc_id, score: each task's best documents of every item."""

    def run(batches):
        best = [_Best(k, floor) for floor in floors]
        flat = np.concatenate(items)
        opens = np.cumsum([0, *map(len, items[:-1])])
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                some = batch.slice(at, BUCKET)
                row, term, impact = impacts.of(some.column(1), some.column(2), some.column(3))
                lengths, ids = some.column(4).to_numpy(), some.column(0).to_pylist()
                _bucket(best, items, flat, opens, row, term, impact, lengths, ids)
        out = [(item_ids[i], None if null else d, -s) for i, b in enumerate(best) for s, null, d in b.rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))],
            names=["item_id", "doc_id", "score"],
        )

    return rows.mapInArrow(run, "item_id long, doc_id long, score long")


def _best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _search_block(docs: DataFrame, terms: DataFrame, k: int, seeds: int) -> DataFrame:
    """The search for one block of items, whose terms are bounded."""
    spark = docs.sparkSession
    asked: dict = {}
    for r in terms.collect():
        asked.setdefault(r["item_id"], []).append(bytes(r["term"]))
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*asked.values())))}
    rows = stage(_occurrences(docs, vocabulary), "occurrences")
    n_docs, n_terms = rows.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r["term"]: r["df"] for r in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("df")
    ).collect()}
    weights = np.zeros(len(vocabulary), np.int64)
    for t, held in df.items():
        weights[t] = weight(n_docs, held)
    # Terms that no document holds, or that weigh nothing, add nothing.
    listed = {i: np.array(sorted(vocabulary[t] for t in ts if weights[vocabulary[t]] > 0), np.int64) for i, ts in asked.items()}
    listed = {i: t for i, t in listed.items() if len(t)}
    if not listed:
        return spark.createDataFrame([], "item_id long, doc_id long, score long")
    item_ids, items = list(listed), list(listed.values())
    impacts = _Impacts(weights, n_docs, n_terms)
    vectors = stage(_with_length(rows, impacts), "vectors")
    longest = vectors.orderBy(F.col("length").desc()).limit(seeds)
    place = {i: at for at, i in enumerate(item_ids)}
    floors = [1] * len(items)
    found = _best_of(_rank(longest, impacts, items, item_ids, k, floors), k)
    for r in found.where(F.col("rank") == k).collect():
        floors[place[r["item_id"]]] = r["score"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = vectors.repartitionByRange(n, F.col("length").desc(), F.xxhash64("doc_id", "n")).sortWithinPartitions(
        F.col("length").desc()
    )
    return _rank(ordered, impacts, items, item_ids, k, floors)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    block_terms: int = BLOCK_TERMS,
    seeds: int = SEEDS,
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` best documents of every item.

    Only scores above zero are returned. Equal scores go by ascending doc_id, null
    ids last. Every row of ``docs`` is a document, repeated rows too; a null or
    empty text has no terms and counts nowhere. Rows of ``items`` with one id (null
    is one) are one item; items without terms, or an empty table, return nothing.
    Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(text).alias("text"))
    terms = stage(item_terms(items), "item-terms")
    blocks = math.ceil(terms.count() / block_terms)
    found = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    for block in range(blocks):
        # Items are dealt to blocks by their id, so that none is split.
        some = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        if not some.isEmpty():
            found = found.unionByName(_search_block(rows, some, k, seeds))
    return _best_of(found, k).select("item_id", "rank", "doc_id", "score")
