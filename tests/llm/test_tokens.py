import zlib

import numpy as np
import pyarrow as pa
import pytest
from edges import DOCUMENTS, documents
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cubestar.llm import attribution, token_planes, tokenizing
from cubestar.llm.tokenizing import SMALL, cache_of, lowered_words, vocabulary_path

WORD_BPE = vocabulary_path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(WORD_BPE)


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.sampled_from([1, 8]))
def test_planes_round_trip(ids, kind):
    assert token_planes.unpack(token_planes.pack(np.array(ids, np.uint32), kind)).tolist() == ids


def test_other_bytes_are_refused():
    with pytest.raises(ValueError):
        token_planes.unpack(b"none" + bytes(30))


@given(st.binary(max_size=200), st.binary(max_size=200))
def test_crc_of_joined(a, b):
    assert token_planes.crc32_combine(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def expected_tokens(rows):
    return [(d, np.array([*TOKENIZER.encode(t or "", add_special_tokens=False).ids, 2], "<u4")) for d, t in rows]


@pytest.mark.parametrize("block, kind", [(64, 8), (1 << 16, 1)])
def test_files(spark, tmp_path, block, kind):
    docs = documents(spark)
    path = str(tmp_path / "planes")
    token_planes.write_planes(docs, path, WORD_BPE, block=block, kind=kind)
    got = token_planes.read_documents(spark, path).orderBy("start").collect()
    want = expected_tokens([(d, t) for d, t, *_ in DOCUMENTS])
    key = lambda x: (x[0] is not None, x[0] or 0)
    assert [key((r["doc_id"],)) for r in got] == sorted(key(w) for w in want)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((str(d), len(i), zlib.crc32(i.tobytes())) for d, i in want)
    starts = np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    assert [r["start"] for r in got] == starts
    sizes = [r["n_ids"] for r in spark.read.parquet(f"{path}/index").collect()]
    assert max(sizes) <= block and sum(sizes) == sum(len(i) for _, i in want)


def test_empty_table(spark):
    assert token_planes.store_tokens(documents(spark, [])).count() == 0


HARD = [
    "İstanbul It's. A.B, ...,. ab'S c'd'e <|endoftext|> X<|startoftext|>Y., ﬁne ΣΑΣ. é́ 漢字 ½ a1b2., we'll. Ⅷ ǅ ﷺ <|EndOfText|>",
    "a. b, C.\nd,\te. f,g. ab.. (ab.) ab.) 1. x.",
    "\x1c\x85\xa0  wide space line. ",
]


@pytest.mark.parametrize("text", HARD)
def test_words_encode_like_the_whole_text(text):
    (ids,) = cache_of("word", WORD_BPE).ids([lowered_words(text.encode())])
    assert np.frombuffer(ids, "<u2").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("letter", ["H\u0331", "J\u030c", "T\u0308", "T\u0344", "W\u030a", "Y\u030a"])
def test_capitals_composed_only_when_small(letter):
    text = f"{letter}ena AB {letter}. Word{letter} {letter.lower()}ab, T"
    (ids,) = cache_of("word", WORD_BPE).ids([lowered_words(text.encode())])
    assert np.frombuffer(ids, "<u2").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@given(st.text(alphabet=st.sampled_from("abZé.,'! \n\tİ1漢-"), max_size=60))
def test_any_text_encodes_like_the_whole(text):
    (ids,) = cache_of("word", WORD_BPE).ids([lowered_words(text.encode())])
    assert np.frombuffer(ids, "<u2").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def laid_out(texts, cache=None):
    ids, bounds = (cache or cache_of("word", WORD_BPE)).laid_out(pa.array([t.encode() for t in texts], pa.binary()))
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


def whole(texts):
    return [e.ids for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]


def test_texts_laid_out_like_the_whole():
    marked = [f"{before}{c}{marks}" for c in SMALL for before in ("", "é", "\u0301", "'") for marks in (".,'", "***", "<|")]
    special = ["", " ", "X<|endoftext|>., a", "<|EndOfText|>.", "S<|startoftext|>***", "it's. dogs'. 'S, 're"]
    composed = ["İ. É, Ω* Å.", "\u0958, \u0958a.", "e\u0301. H\u0331, h\u0345.", "a\xa0. b\x1c, 1. ½,"]
    texts = [*HARD, *marked, *special, *composed]
    assert laid_out(texts) == whole(texts)
    assert laid_out([]) == []


@given(st.lists(st.text(alphabet=st.sampled_from("abSZÉé.,'! \n\tİ1漢-*<|>\u0301ςя\u0958\xa0"), max_size=40), max_size=5))
def test_any_texts_laid_out_like_the_whole(texts):
    assert laid_out(texts) == whole(texts)


def test_bytes_that_are_no_text_are_laid_out_as_words():
    texts = [b"a\xff. B\xc3, \xe9\xc3\xa9. ok", b"\xc3 \xa9."]
    cache = cache_of("word", WORD_BPE)
    ids, bounds = cache.laid_out(pa.array(texts, pa.binary()))
    words = cache.ids([lowered_words(t) for t in texts])
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [np.frombuffer(w, "<u2").tolist() for w in words]


@pytest.mark.parametrize("bound", [800_000, 3])
def test_a_word_is_encoded_once_whatever_marks_follow(monkeypatch, bound):
    monkeypatch.setattr(tokenizing, "MAX_CACHED_WORDS", bound)
    given_words = []

    def encode(words):
        given_words.extend(words)
        return inner.encode(words)

    inner = cache_of("word", WORD_BPE)
    cache = tokenizing.WordCache(encode)
    texts = ["Anhe anhe*** anhe. ANHE, été*** Été. Été, été!! été", "anhe%%% été%%% anhe."]
    for _ in range(2):
        assert laid_out(texts, cache) == whole(texts)
    once = {"anhe", "été", "Été", *"%%% *** . , !!".split(), ""}
    assert set(given_words) == {w.encode() for w in once}
    assert bound == 3 or len(given_words) == len(once)


def test_a_worker_keeps_the_words_of_one_vocabulary():
    """The words of quality_rules went on filling the workers that encode for token_files."""
    piece = vocabulary_path("piece_bpe_32k.model")
    before = cache_of("piece", piece).ids([[b"one", b"two"]])
    assert laid_out(["one two three"]) == whole(["one two three"])
    assert cache_of("word", WORD_BPE).words and not tokenizing._caches["piece", piece].words
    assert cache_of("piece", piece).ids([[b"one", b"two"]]) == before
    assert not tokenizing._caches["word", WORD_BPE].words


def test_attribution_edges(spark):
    docs = documents(spark)
    rows = attribution.count_tokens(docs).collect()
    assert len(rows) == len(DOCUMENTS)
    for r in rows:
        text = r["text"] or ""
        assert r["n_chars"] == len(text) and sum(r["section_tokens"]) + r["n_unattributed"] == r["n_tokens"]
        assert r["n_sections"] == (len(text.split("\n")) - text.endswith("\n") if text else 0)
    assert attribution.count_tokens(documents(spark, [])).count() == 0


def test_boundary_rule(spark):
    """A crossing token goes where most of its characters are, else to the earlier section."""
    a = np.array
    counts, crossing, outside = attribution.attribute(a([0, 3, 6, 12]), a([3, 6, 8, 14]), a([0, 4, 7]), a([4, 7, 9]))
    assert counts.tolist() == [1, 2, 0] and crossing == 2 and outside == 1


def test_given_sections(spark):
    docs = spark.createDataFrame(
        [(1, "one two three", [(0, 4), (4, 8)]), (2, "é漢🎉 x", [(0, 2)]), (3, "text", []), (4, None, None)],
        "doc_id long, text string, parts array<struct<start:int,end:int>>",
    )
    got = {r["doc_id"]: r for r in attribution.count_tokens(docs, carry=["doc_id"], sections="parts").collect()}
    assert got[1]["n_tokens"] == sum(got[1]["section_tokens"]) + got[1]["n_unattributed"]
    assert got[3]["n_sections"] == 0 and got[3]["n_unattributed"] == got[3]["n_tokens"] > 0
    assert got[4]["n_tokens"] == 0
