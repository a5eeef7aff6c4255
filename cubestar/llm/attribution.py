"""Token counts of sections by offset mapping.

A whole document is encoded once. Byte-level tokens tile the text, so the
running sum of their lengths gives each token's character span, and an interval
join of the two sorted lists of spans attributes tokens to sections.

Rule for a token that crosses a boundary: it counts for the section that holds
most of its characters, the earlier one if equal; a token in no section counts
for none.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubestar.llm.common import carrying
from cubestar.llm.tokenizing import vocabulary_path

SCHEMA = (
    "n_chars long, n_tokens long, n_sections long, n_crossing long, n_unattributed long,"
    " section_tokens array<long>"
)
_encoders: dict[str, tuple] = {}


def encoder(path: str):
    """(encode, lengths): the function from text to ids and bytes by id."""
    if path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        own = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        _encoders[path] = own.encode_ordinary, lengths
    return _encoders[path]


def token_spans(text: str, encode, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of each token; a split character counts for each part."""
    ids = np.asarray(encode(text), np.int64)
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    raw = text.encode()
    if len(raw) == len(text):
        return starts, ends
    character = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1
    return character[starts], character[ends - 1] + 1


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lines with their line feed; an empty text has none."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lengths = np.fromiter(map(len, text.split("\n")), np.int64) + 1
    ends = np.cumsum(lengths)
    starts = ends - lengths
    ends[-1] -= 1
    return (starts[:-1], ends[:-1]) if starts[-1] == ends[-1] else (starts, ends)


def attribute(starts, ends, section_starts, section_ends) -> tuple[np.ndarray, int, int]:
    """(tokens by section, crossing tokens, tokens in no section).

    Sections are sorted and do not overlap; empty sections get no token.
    """
    n = len(section_starts)
    counts = np.zeros(n, np.int64)
    if not n or not len(starts):
        return counts, 0, len(starts)
    first = np.searchsorted(section_ends, starts, "right")
    last = np.searchsorted(section_starts, ends, "left") - 1
    inside = first == last
    counts += np.bincount(first[inside], minlength=n)[:n]
    crossing = 0
    for t in np.flatnonzero(first < last).tolist():
        held = np.arange(first[t], last[t] + 1)
        share = np.minimum(section_ends[held], ends[t]) - np.maximum(section_starts[held], starts[t])
        crossing += int((share > 0).sum() > 1)
        counts[held[int(np.argmax(share))]] += 1
    return counts, crossing, int((first > last).sum())


def count_tokens(
    docs: DataFrame,
    carry: list[str] | None = None,
    sections: str | None = None,
    vocabulary: str | None = None,
    text: str = "text",
) -> DataFrame:
    """The carried columns (default: all) with the token counts of every row.

    ``sections`` names a column array<struct<start,end>> of character spans
    (code points, end exclusive), sorted and without overlap; without it, and
    where it is null, the lines of the text are its sections. ``section_tokens``
    has one count per section, and its sum and ``n_unattributed`` make
    ``n_tokens``. A null or empty text has no tokens. Repeated rows are counted
    each; carried columns with the name of a result are replaced.
    """
    path = vocabulary or vocabulary_path("byte_bpe_50k.tiktoken")
    kind = "array<struct<start:long,end:long>>"
    spans = F.col(sections).cast(kind) if sections else F.lit(None).cast(kind)
    work, schema, columns = carrying(
        docs, carry, SCHEMA, [F.coalesce(text, F.lit("")).alias("text"), spans.alias("sections")]
    )
    names = ["carried", *[c.split()[0] for c in SCHEMA.split(", ")]]
    types = [pa.int64()] * 5 + [pa.list_(pa.int64())]

    def run(batches):
        encode, lengths = encoder(path)
        for batch in batches:
            rows = []
            for value, given in zip(batch.column(1), batch.column(2)):
                t, given = value.as_py(), given.as_py()
                if given is None:
                    held = line_spans(t)
                else:
                    pairs = np.array([(s["start"], s["end"]) for s in given], np.int64).reshape(-1, 2)
                    held = pairs[:, 0], pairs[:, 1]
                starts, ends = token_spans(t, encode, lengths)
                counts, crossing, outside = attribute(starts, ends, *held)
                rows.append((len(t), len(starts), len(counts), crossing, outside, counts))
            added = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0), *added], names=names)

    return work.mapInArrow(run, schema).select(*columns)
