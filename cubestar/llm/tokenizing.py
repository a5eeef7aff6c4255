"""Public tokenizers inside tasks, with bounded caches of encoded words."""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words kept encoded in a Python worker; a full cache starts anew.
MAX_CACHED_WORDS = 800_000

#: Unknown words that are encoded as one text.
JOINED_WORDS = 256

#: Words whose ids are laid out at a time.
LAID_WORDS = 1 << 18

#: Characters that a tokenizer never joins with a letter before them.
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())

#: Small letters of two bytes that normalizing and lowering leave as they are.
SMALL = [
    c
    for c in map(chr, range(0xDF, 0x500))
    if c.isalpha() and c.islower() and c == c.lower() == unicodedata.normalize("NFC", c)
]

#: Whether marks may be cut off behind the last two bytes of a word.
_CLOSING = np.zeros((256, 256), bool)
_CLOSING[:, list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_CLOSING[tuple(np.frombuffer("".join(SMALL).encode(), np.uint8).reshape(-1, 2).T)] = True
_CLOSING = _CLOSING.ravel()

_caches: dict[tuple[str, str], WordCache] = {}


def _runs(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``sizes[i]`` items of the pool from ``starts[i]`` on, for all i."""
    before = np.cumsum(sizes) - sizes
    return pool[np.repeat(starts - before, sizes) + np.arange(sizes.sum())]


def _strings(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an array of strings."""
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int32)[array.offset : array.offset + len(array) + 1]
    return np.frombuffer(data or b"", np.uint8), at.astype(np.int64)


def stems_and_marks(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Words lowered as by ``lowered_words``, and the marks behind their last letter.

    Marks are cut off behind A-Z, a-z and ``SMALL``: other characters can end in a mark
    once they are normalized. The string of a special token stays whole.
    """
    special = pc.match_substring(words, "<|")
    words = pc.if_else(pc.and_not(pc.string_is_ascii(words), special), pc.ascii_lower(words), words)
    stems = pc.ascii_rtrim(words, characters=MARKS)
    data, at = _strings(stems)
    ends = np.pad(data, (2, 0))[at[1:, None] + [0, 1]].astype(np.int64)
    last = np.where(np.diff(at) > 1, ends[:, 0] << 8, 0) | ends[:, 1]
    cut = pa.array(_CLOSING[last] & (np.diff(at) > 0))
    stems = pc.if_else(pc.and_not(cut, special), stems, words)
    data, at = _strings(words)
    sizes = np.diff(at) - pc.binary_length(stems).to_numpy()
    marks = _runs(data, at[1:] - sizes, sizes)
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return stems, pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(marks)])


class WordCache:
    """Word (bytes) to encoded ids as little-endian unsigned 16-bit bytes."""

    def __init__(self, encode):
        self.encode = encode
        self.words: dict[bytes, bytes] = {}

    def fill(self, words: set[bytes]) -> None:
        known = self.words
        missing = [w for w in words if w not in known]
        if len(known) + len(missing) > MAX_CACHED_WORDS:
            known.clear()
            missing = list(words)
        known.update(zip(missing, self.encode(missing)))

    def ids(self, texts: list[list[bytes]]) -> list[bytes]:
        """The ids of each list of words."""
        self.fill(set().union(*texts) if texts else set())
        look = self.words.__getitem__
        return [b"".join(map(look, words)) for words in texts]

    def laid_out(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (bytes, none null) in a row, and where each text's begin and end.

        For a lower-casing tokenizer. Each different word of the texts is looked up
        once, by its stem and its marks.
        """
        split = pc.ascii_split_whitespace(texts.cast(pa.binary()).view(pa.string()))
        words = split.flatten().dictionary_encode()
        parts = pa.concat_arrays(stems_and_marks(words.dictionary)).dictionary_encode()
        sizes, pool = self._looked_up(parts.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False).tolist())
        # A word is its stem, then its marks.
        at = parts.indices.to_numpy().reshape(2, -1).T
        pool = _runs(pool, (np.cumsum(sizes) - sizes)[at.ravel()], sizes[at.ravel()])
        sizes = sizes[at].sum(axis=1)
        starts, at = np.cumsum(sizes) - sizes, words.indices.to_numpy()
        blocks = (at[i : i + LAID_WORDS] for i in range(0, len(at), LAID_WORDS))
        ids = np.concatenate([pool[:0], *(_runs(pool, starts[b], sizes[b]) for b in blocks)])
        return ids, np.append(0, np.cumsum(sizes[at]))[split.offsets.to_numpy()]

    def _looked_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids of different words, and all their ids in a row."""
        known = self.words
        found = list(map(known.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(missing, self.encode([words[i] for i in missing])):
            found[i] = ids
        if len(known) + len(missing) > MAX_CACHED_WORDS:
            known.clear()
            missing = range(len(words))
        known.update((words[i], found[i]) for i in missing)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 2
        return sizes, np.frombuffer(b"".join(found), "<u2")


def _packed(ids) -> bytes:
    return np.asarray(ids, dtype="<u2").tobytes()


def _word_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    closing = np.zeros(1 << 16, bool)
    closing[[i for token, i in tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def separate(words: list[str]) -> list[bytes]:
        return [_packed(e.ids) for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def together(words: list[str]) -> list[bytes]:
        """Words of letters as one text: each ends with a closing token.

        A word that the tokenizer cuts has more than one, so equal numbers mean
        that no word was cut.
        """
        (whole,) = tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.asarray(whole.ids, dtype="<u2")
        ends = np.flatnonzero(closing[ids]) + 1
        if len(ends) != len(words):
            return separate(words)
        raw, cuts = ids.tobytes(), [0, *(2 * ends).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(words: list[bytes]) -> list[bytes]:
        texts = [w.decode(errors="replace") for w in words]
        letters = [i for i, w in enumerate(texts) if w.isalpha()]
        others = [i for i, w in enumerate(texts) if not w.isalpha()]
        out: list[bytes] = [b""] * len(words)
        for at in range(0, len(letters), JOINED_WORDS):
            some = letters[at : at + JOINED_WORDS]
            for i, ids in zip(some, together([texts[i] for i in some])):
                out[i] = ids
        for i, ids in zip(others, separate([texts[i] for i in others])):
            out[i] = ids
        return out

    return encode


def _piece_tokenizer(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(words: list[bytes]) -> list[bytes]:
        texts = [w.decode(errors="replace") for w in words]
        return [_packed(ids) for ids in model.encode(texts, num_threads=1)]

    return encode


def cache_of(kind: str, path: str) -> WordCache:
    """The worker's cache for a vocabulary file; tasks of one worker share it.

    A worker outlives the stage it was started for, so only the vocabulary asked for
    last keeps its words; another one's are encoded anew when it is asked for again.
    """
    if (kind, path) not in _caches:
        make = {"word": _word_tokenizer, "piece": _piece_tokenizer}[kind]
        _caches[kind, path] = WordCache(make(path))
    for key, other in _caches.items():
        if key != (kind, path):
            other.words.clear()
    return _caches[kind, path]


def lowered_words(text: bytes) -> list[bytes]:
    """Words that a lower-casing tokenizer encodes one by one like the whole text.

    Such a tokenizer drops blanks and never joins letters with other characters.
    Only words of ASCII are lowered: the tokenizer composes before it lowers, and
    a capital with a mark may have no composed form where its small letter has.
    Words that could hold the string of a special token keep their case.
    """
    if text.isascii() and b"<|" not in text:
        return text.lower().split()
    return [w.lower() if w.isascii() and b"<|" not in w else w for w in text.split()]


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
