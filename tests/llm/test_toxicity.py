import random

from edges import DOCUMENTS, documents

from cubestar.llm import toxicity

RUDE = ["idiotic", "worthless", "scummy"]


def sample(n=240, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(300)]
    out = []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randint(30, 200))
        toxic = int(i % 4 == 0)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(RUDE))
        out.append((i, " ".join(words).encode(), toxic))
    return out


def test_learns_from_few_rows():
    score = toxicity.fit_sample(sample()).scorer()
    right = [(score(text) >= toxicity.THRESHOLD) == bool(toxic) for _, text, toxic in sample(80, seed=2)]
    assert sum(right) >= 76


def test_score_reads_the_end_of_a_long_text():
    score = toxicity.fit_sample(sample()).scorer()
    body = b"word1 word2 word3 " * 40_000
    assert score(body) < 0.5 < score(body + b"Idiotic, WORTHLESS scummy worthless! idiotic scummy")


def test_without_both_classes():
    score = toxicity.fit_sample([(1, b"only one", 1)]).scorer()
    assert score(b"only one") < 0.1
    assert toxicity.fit_sample([]).scorer()(b"") < 0.1


def test_edges(spark):
    docs = documents(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 1), (2, 0, 0), (None, 1, 1), (3, 1, None), (99, 1, 1)], "doc_id long, quality int, toxic int"
    )
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(DOCUMENTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(not r["held_out"] for r in rows if r["doc_id"] is None)
    empty = toxicity.fit(documents(spark, []), labels.limit(0))
    assert toxicity.score(documents(spark, []), empty).count() == 0


def test_equal_texts_have_equal_scores(spark):
    docs = documents(spark)
    model = toxicity.fit_sample(sample())
    by_text = {}
    for r, d in zip(toxicity.score(docs, model).collect(), docs.collect()):
        assert by_text.setdefault(d["text"] or "", r["score"]) == r["score"]
