import pytest
from edges import DOCUMENTS, documents, words

from cubestar.llm import quality


def expected_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    own = words(text)
    windows = {}
    for i in range(len(own) - 7):
        windows.setdefault(tuple(own[i : i + 8]), []).append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(8)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    return (
        len(own),
        sum(map(len, own)),
        sum(c in "#*$%&|<>" for w in own for c in w),
        len(lines) - len(set(lines)),
        len(covered),
        len(own) < 20 or 100 * len(covered) > 30 * len(own),
    )


def test_edges(spark):
    docs = documents(spark)
    rows = quality.assess(docs, carry=["copies", "doc_id", "text"]).collect()
    assert len(rows) == len(DOCUMENTS)
    for r in rows:
        assert tuple(r[m] for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == expected_counts(r["text"])
        if r["base_failed"]:
            assert not r["kept"]


def test_all_columns_and_empty_table(spark):
    docs = documents(spark)
    full = quality.assess(docs)
    assert [c for c in docs.columns if c not in ("kept", "n_tokens")] == full.columns[: len(docs.columns) - 2]
    assert quality.assess(documents(spark, [])).count() == 0


@pytest.mark.parametrize("text, script", [("plain words", "latin"), ("слова и буквы", "greek_cyrillic"), ("漢字かな", "other"), ("", "latin")])
def test_script(text, script):
    assert quality.script_of(text) == script


def test_bands_reject_fallback_and_monotony():
    assert quality.verdict("en", b"x", 500, 3.0, 0.5, 7.0) == "fallback_share"
    assert quality.verdict("en", b"x", 500, 1.0, 0.0, 7.0) == "chars_per_token"
    assert quality.verdict("en", b"x", 500, 3.0, 0.0, 3.0) == "token_entropy"
    assert quality.verdict("en", b"x", 500, 3.0, 0.0, 7.0) is None
