"""Quality rules by tokeniser fertility.

Each word of a whole text is encoded with a public vocabulary (the pieces of that
vocabulary never cross blanks). Three measures follow: characters per token, the
share of byte-fallback tokens, and the entropy of the token distribution. A text
outside the bands of its language, or of its script where the language has none,
is rejected. Plain counts of words, symbols, lines and repeats come first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubestar.llm.common import carrying, utf8
from cubestar.llm.tokenizing import cache_of, vocabulary_path

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
#: Bytes of text that a task encodes at a time.
BATCH_BYTES = 4 << 20


@dataclass(frozen=True)
class Bands:
    """Characters per token between the two bounds, fallback share up to a bound."""

    min_chars: float
    max_chars: float = 8.0
    max_fallback: float = 0.1


#: Bands by language, wide enough for names, numbers and quotations in a text.
LANGUAGE_BANDS = {
    "de": Bands(1.9),
    "en": Bands(1.7),
    "es": Bands(1.6),
    "fr": Bands(1.55),
}

#: Bands of texts in other or unknown languages, by the script of most letters.
SCRIPT_BANDS = {
    "latin": Bands(1.4),
    "greek_cyrillic": Bands(0.8, 8.0, 0.2),
    "other": Bands(0.25, 8.0, 0.9),
}

#: (tokens from, least entropy in bits): longer texts repeat fewer of their tokens
#: in a row, whatever the language.
ENTROPY_FLOOR = ((0, 3.9), (100, 5.0), (200, 5.45), (400, 5.8), (800, 6.05), (1600, 6.15), (3200, 6.2))

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, n_tokens long, chars_per_token double,"
    " fallback_share double, token_entropy double, reason string"
)
_TYPES = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string()}
_ODD = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1)) & (2**64 - 1) | 1 for k in range(WINDOW)], np.uint64)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur at least twice; windows may overlap."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = codes[:n] * _ODD[0]
    for k in range(1, window):
        mixed = mixed + codes[k : k + n] * _ODD[k]
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    if not same.any():
        return 0
    found: dict[tuple, list[int]] = {}
    for at in order[np.append(same, False) | np.insert(same, 0, False)].tolist():
        found.setdefault(tuple(words[at : at + window]), []).append(at)
    edges = np.zeros(len(words) + 1, np.int64)
    for places in found.values():
        if len(places) > 1:
            np.add.at(edges, places, 1)
            np.add.at(edges, np.asarray(places) + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    joined = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(joined.decode(errors="replace")),
        len(joined) - len(joined.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def fertility(ids: np.ndarray, word_chars: int, fallback: np.ndarray) -> tuple[float, float, float]:
    """Characters per token, byte-fallback share, token entropy in bits."""
    n = len(ids)
    if not n:
        return 0.0, 0.0, 0.0
    ordered = np.sort(ids)
    ends = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True))
    counts = np.diff(ends, prepend=-1).astype(np.float64)
    entropy = np.log2(n) - float((counts * np.log2(counts)).sum()) / n
    return word_chars / n, float(fallback[ids].mean()), max(0.0, entropy)


def script_of(text: str) -> str:
    """The script of most letters; texts without letters count as latin."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    latin = int((((points | 32) >= 97) & ((points | 32) <= 122)).sum())
    latin += int(((points >= 0xC0) & (points < 0x370)).sum())
    eastern = int(((points >= 0x370) & (points < 0x530)).sum())
    other = int((points >= 0x530).sum())
    return max(("latin", latin), ("greek_cyrillic", eastern), ("other", other), key=lambda x: x[1])[0]


def entropy_floor(n_tokens: int) -> float:
    return max(floor for start, floor in ENTROPY_FLOOR if n_tokens >= start)


def verdict(lang: str | None, text: bytes, n: int, chars: float, share: float, entropy: float) -> str | None:
    """The band that a text violates, or None."""
    bands = LANGUAGE_BANDS.get(lang) or SCRIPT_BANDS[script_of(text.decode(errors="replace"))]
    if not bands.min_chars <= chars <= bands.max_chars:
        return "chars_per_token"
    if share > bands.max_fallback:
        return "fallback_share"
    if entropy < entropy_floor(n):
        return "token_entropy"
    return None


def assess(
    docs: DataFrame,
    carry: list[str] | None = None,
    vocabulary: str | None = None,
    text: str = "text",
    lang: str | None = "lang",
) -> DataFrame:
    """The carried columns (default: all) with the measures and verdict of each row.

    A null text has no words and fails the base rules, as does any text of fewer
    than ``MIN_WORDS`` words. ``kept`` is false for a failed text, else the
    verdict of the bands; ``reason`` names why a row is not kept. A null or
    unknown language takes the bands of the script. Repeated rows are judged one
    by one, and carried columns with the name of a measure are replaced.
    """
    names = ["carried", *[m.split()[0] for m in MEASURES.split(", ")]]
    types = [_TYPES[m.split()[1]] for m in MEASURES.split(", ")]
    path = vocabulary or vocabulary_path("piece_bpe_32k.model")
    known = F.col(lang) if lang and lang in docs.columns else F.lit(None).cast("string")
    work, schema, columns = carrying(docs, carry, MEASURES, [utf8(text).alias("text"), known.alias("lang")])

    def run(batches):
        cache = cache_of("piece", path)
        fallback = np.zeros(1 << 16, bool)
        fallback[byte_pieces(path)] = True

        def measured(texts, langs):
            split = [t.split() for t in texts]
            for t, words, language, ids in zip(texts, split, langs, cache.ids(split)):
                counts = base_counts(t, words)
                ids = np.frombuffer(ids, "<u2")
                measures = fertility(ids, counts[1], fallback)
                if counts[0] < MIN_WORDS:
                    reason, failed = "n_words", True
                elif 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0]:
                    reason, failed = "n_repeat_words", True
                else:
                    reason, failed = verdict(language, t, len(ids), *measures), False
                yield (*counts, failed, reason is None, len(ids), *measures, reason)

        for batch in batches:
            texts, langs, rows, at, size = [], [], [], 0, 0
            all_langs = batch.column(2).to_pylist()
            for i, value in enumerate(batch.column(1)):
                texts.append(value.as_py())
                size += len(texts[-1])
                if size >= BATCH_BYTES:
                    rows += measured(texts, all_langs[at : i + 1])
                    texts, at, size = [], i + 1, 0
            rows += measured(texts, all_langs[at:])
            added = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0), *added], names=names)

    return work.mapInArrow(run, schema).select(*columns)


def byte_pieces(path: str) -> list[int]:
    """The ids of the vocabulary's byte-fallback pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [i for i in range(model.get_piece_size()) if model.is_byte(i)]
