"""Words of whole texts in bounded pieces, and hashes of word shingles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import xxhash

#: Bytes that are cut into words at a time; a single longer word stays whole.
PIECE_BYTES = 4 << 20
#: Hashes of short words are kept, up to this many in a Python worker.
MAX_KEPT, MAX_KEPT_BYTES = 400_000, 32

_BLANKS = b" \t\n\x0b\x0c\r"


def pieces(raw: bytes, blanked: Callable[[bytes], bytes] | None = None, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes that end between words.

    ``blanked`` turns whatever parts words into blanks, byte by byte.
    """
    text = raw if blanked is None else blanked(raw)
    at = 0
    while len(text) - at > size:
        cut = at + size
        while cut < len(text) and text[cut] not in _BLANKS:
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finish)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """Word (bytes) to its 64-bit hash; short words are kept."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= MAX_KEPT_BYTES and len(self) < MAX_KEPT:
            self[word] = h
        return h

    def of(self, raw: bytes) -> np.ndarray:
        """Hashes of all words, A-Z lowered, cut at ASCII blanks."""
        found = []
        for piece in pieces(raw, bytes.lower):
            words = piece.split()
            found.append(np.fromiter(map(self.__getitem__, words), np.uint64, len(words)))
        return found[0] if len(found) == 1 else np.concatenate(found)


_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes, ascending, of the ``n``-word shingles (at most four words).

    Fewer words are one shingle; no words are none.
    """
    held = min(n, len(hashes))
    if not held:
        return np.zeros(0, np.uint64)
    count = len(hashes) - held + 1
    total = np.full(count, held, np.uint64)
    for i in range(held):
        total += hashes[i : i + count] * _FACTORS[i]
    return np.unique(mixed(total))
