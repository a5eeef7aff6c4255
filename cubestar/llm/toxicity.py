"""Toxicity by compression distance between two zstandard dictionaries.

A text is cut into windows of words, and every word is written as an eight-byte
code, so that a compressor can only match whole words. A window is compressed
with an ordinary and with a toxic dictionary; the bytes that the toxic one saves
are the window's gain. A document's largest gains, through a logistic curve
calibrated on labelled rows that no dictionary has seen, are its score.

Both dictionaries end in the same frequent words. Before them stand the words
that distinguish the labelled texts of their class, by the likelihood ratio of
document frequencies. Near copies in the sample count as one document there, and
stay together on one side of the calibration.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubestar.llm.common import map_batches, utf8

#: The bounded sample that is learned from: documents by class, characters of each.
MAX_TOXIC = 1_500
MAX_ORDINARY = 4_000
MAX_SAMPLE_CHARS = 20_000

WINDOW = 16
SIGNATURES = 4
TOP_WINDOWS = 3
MIN_DOCUMENTS = 3
MIN_RATIO = 8.0
MIN_LIKELIHOOD = 10.0
MAX_CLASS_WORDS = 512
SHARED_WORDS = 512
THRESHOLD = 0.7
MAX_CODES = 400_000
_MARGINS = b".,;:!?\"'()|*$%&#<>-"


class _Codes(dict):
    """Word to its eight-byte code; words lose the marks around them."""

    def __missing__(self, word: bytes) -> bytes:
        bare = word.strip(_MARGINS)
        code = xxhash.xxh64_digest(bare) if bare else b""
        if len(self) >= MAX_CODES:
            self.clear()
        self[word] = code
        return code


def coded(text: bytes, codes: _Codes) -> bytes:
    return b"".join(map(codes.__getitem__, text.lower().split()))


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    bias: float
    weights: tuple[float, float]

    def scorer(self):
        """A function from text (bytes) to score."""
        gains, codes = _gains(self.ordinary, self.toxic), _Codes()
        return lambda text: self.probability(*_features(gains(coded(text, codes))))

    def probability(self, largest: float, several: float) -> float:
        z = self.bias + self.weights[0] * largest + self.weights[1] * several
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def _compressor(dictionary: bytes):
    """The greedy strategy finds every word of a dictionary; the fast one loses some
    to equal hashes, which looks like a gain of the other dictionary."""
    parameters = zstandard.ZstdCompressionParameters.from_level(
        1,
        min_match=6,
        hash_log=16,
        chain_log=16,
        search_log=3,
        write_content_size=0,
        write_checksum=0,
        write_dict_id=0,
        strategy=zstandard.STRATEGY_GREEDY,
    )
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=parameters).compress


def _gains(ordinary: bytes, toxic: bytes):
    """A function from a coded text to the gains of all its windows."""
    plain, marked = _compressor(ordinary), _compressor(toxic)
    size = 8 * WINDOW

    def gains(code: bytes) -> list[int]:
        windows = (code[at : at + size] for at in range(0, len(code), size))
        return [len(plain(w)) - len(marked(w)) for w in windows]

    return gains


def _features(gains: list[int]) -> tuple[float, float]:
    top = sorted(gains, reverse=True)[:TOP_WINDOWS]
    return (top[0] / 10, sum(max(0, g) for g in top) / 10) if top else (0.0, 0.0)


def copy_groups(codes: list[bytes]) -> list[int]:
    """A group number for each coded text; near copies share the smallest hash of
    their word pairs in one of ``SIGNATURES`` orders, and with it the group."""
    parent = list(range(len(codes)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    seen: dict[tuple[int, int], int] = {}
    for i, code in enumerate(codes):
        words = np.frombuffer(code, np.uint64)
        pairs = words[:-1] * np.uint64(3) + words[1:] if len(words) > 1 else words
        for k in range(SIGNATURES if len(pairs) else 0):
            mixed = (pairs ^ np.uint64(k * 0x9E3779B97F4A7C15 & (2**64 - 1))) * np.uint64(0xD6E8FEB86659FD93)
            first = seen.setdefault((k, int((mixed ^ (mixed >> np.uint64(32))).min())), i)
            parent[find(i)] = find(first)
    return [find(i) for i in range(len(codes))]


def _document_counts(texts: list[bytes], codes: _Codes) -> tuple[Counter, int]:
    """Documents by word, and all documents; a group of near copies is one document."""
    coded_texts = [coded(text, codes) for text in texts]
    groups: dict[int, set[bytes]] = {}
    for group, code in zip(copy_groups(coded_texts), coded_texts):
        groups.setdefault(group, set()).update(code[at : at + 8] for at in range(0, len(code), 8))
    found: Counter = Counter()
    for words in groups.values():
        found.update(words)
    return found, len(groups)


def distinguishing(own: Counter, n_own: int, other: Counter, n_other: int) -> list[bytes]:
    """Word codes typical of one class, the most telling last."""
    weight = {}
    for word, k in own.items():
        n = other.get(word, 0)
        p, q = k / n_own, n / n_other
        if k < MIN_DOCUMENTS or p < MIN_RATIO * q:
            continue
        both = (k + n) / (n_own + n_other)
        likelihood = k * math.log(p / both) + (n * math.log(q / both) if n else 0)
        if likelihood >= MIN_LIKELIHOOD:
            weight[word] = likelihood
    return sorted(weight, key=lambda w: (weight[w], w))[-MAX_CLASS_WORDS:]


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionaries of equal length."""
    codes = _Codes()
    (t, n_toxic), (o, n_ordinary) = _document_counts(toxic, codes), _document_counts(ordinary, codes)
    marked = distinguishing(t, n_toxic, o, n_ordinary)
    plain = distinguishing(o, n_ordinary, t, n_toxic)
    own = {*marked, *plain}
    frequent = sorted((t + o).items(), key=lambda x: (-x[1], x[0]))
    shared = b"".join(w for w, _ in frequent[:SHARED_WORDS][::-1] if w not in own)
    size = 8 * max(len(marked), len(plain), 1)
    return tuple(b"".join(part).rjust(size, b"\0") + shared for part in (plain, marked))


def calibrate(features: np.ndarray, labels: np.ndarray) -> tuple[float, tuple[float, float]]:
    """Logistic regression by Newton steps, lightly regularised, moved so that the
    cut with the best balance of precision and recall (F1) has ``THRESHOLD``."""
    x = np.column_stack([np.ones(len(features)), features])
    w = np.zeros(3)
    ridge = np.diag([1e-3, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        gradient = x.T @ (labels - p) - ridge @ w
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, gradient)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    z = x @ w
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + labels.sum())
    ends = np.append(z[order[1:]] != z[order[:-1]], True)
    best = int(np.argmax(np.where(ends, f1, -1.0)))
    # Half way to the next score below, so that equal scores fall on one side.
    below = z[order[best + 1]] if best + 1 < len(z) else z[order[best]] - 1
    cut = (z[order[best]] + below) / 2
    bias = float(w[0]) - cut + math.log(THRESHOLD / (1 - THRESHOLD))
    return bias, (float(w[1]), float(w[2]))


def fit_sample(sample: list[tuple[int, bytes, int]]) -> ToxicityModel:
    """The model of (doc_id, text, toxic) rows; a quarter of them only calibrates.

    Without both classes there is nothing to learn and every score is near 0.
    """
    codes = _Codes()
    groups = copy_groups([coded(t, codes) for _, t, _ in sample])
    held = [zlib.crc32(f"calibrate:{sample[g][0]}".encode()) % 4 == 0 for g in groups]
    part = {
        (side, y): [t for (_, t, label), h in zip(sample, held) if h == side and label == y]
        for side in (False, True)
        for y in (0, 1)
    }
    if not (part[False, 0] and part[False, 1]):
        return ToxicityModel(b"\0" * 8, b"\0" * 8, -5.0, (0.0, 0.0))
    ordinary, toxic = train_dictionaries(part[False, 1], part[False, 0])
    if not (part[True, 0] and part[True, 1]):
        return ToxicityModel(ordinary, toxic, -4.0, (2.0, 3.0))
    gains = _gains(ordinary, toxic)
    rows = [(_features(gains(coded(t, codes))), y) for y in (0, 1) for t in part[True, y]]
    bias, weights = calibrate(
        np.array([f for f, _ in rows]), np.array([float(y) for _, y in rows])
    )
    return ToxicityModel(ordinary, toxic, bias, weights)


def in_third(c, remainder: int = 1) -> F.Column:
    """Whether crc32 of the id as text leaves the remainder; false for null."""
    return F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")) % 3 == remainder, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_toxic: int = MAX_TOXIC,
    max_ordinary: int = MAX_ORDINARY,
    max_chars: int = MAX_SAMPLE_CHARS,
) -> ToxicityModel:
    """Learn from a bounded sample of the labelled rows outside the held-out third.

    The sample is the labelled ids of each class with the smallest hashes, up to
    the bounds, and of those the texts up to ``max_chars`` characters. An id that
    is labelled twice is toxic if any label says so. Null ids or labels and
    missing or null texts are left out.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(~in_third("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("_h", F.xxhash64("doc_id"))
    )
    smallest = lambda y, n: known.where(F.col("toxic") == y).orderBy("_h", "doc_id").limit(n)
    chosen = smallest(1, max_toxic).unionByName(smallest(0, max_ordinary)).drop("_h")
    texts = (
        docs.select("doc_id", "text")
        .where("text IS NOT NULL")
        .where(F.length("text") <= max_chars)
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    )
    rows = texts.orderBy("doc_id").collect()
    return fit_sample([(r["doc_id"], r["text"].encode(), int(r["toxic"])) for r in rows])


def score(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row, from its whole text alone.

    Null and empty texts have no window and score as texts without any gain.
    Repeated rows are scored each; other columns are ignored.
    """

    def step():
        of = model.scorer()

        def run(batch):
            scores = [of(t.as_py()) for t in batch.column(2)]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

        return run

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), in_third(doc_id).alias("held_out"), utf8(text).alias("text")
    )
    return map_batches(rows, step, "doc_id long, held_out boolean, score double, predicted int")
