import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklens.llm import langid, ranking, toxicity
from tracklens.llm.common import remainder

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def auc(rows):
    good = np.array([s for y, s in rows if y == 1])
    bad = np.array([s for y, s in rows if y == 0])
    return (good[:, None] > bad[None, :]).mean() + (good[:, None] == bad[None, :]).mean() / 2


def test_language_on_held_out_rows(docs, odd, empty):
    model = langid.train(docs.where(remainder("doc_id", 4) != 2))
    held = langid.predict(docs.where(remainder("doc_id", 4) == 2), model).collect()
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert np.mean([r.lang == r.lang_pred for r in held if r.accepted]) > 0.98
    rows = langid.predict(odd.withColumnRenamed("n_chars", "score"), model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert all((r.lang_pred == "und") == (not r.text or not r.text.strip()) for r in rows)
    assert langid.predict(empty, model).count() == 0
    none = langid.train(empty)
    assert {r.lang_pred for r in langid.predict(odd, none).collect()} == {"und"}


def test_language_ignores_all_but_the_text(docs):
    model = langid.train(docs)
    few = docs.limit(30)
    other = few.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    first = {r.doc_id: r.lang_pred for r in langid.predict(few, model).collect()}
    assert first == {r.doc_id: r.lang_pred for r in langid.predict(other, model).collect()}


def test_toxicity_learns_words_and_pairs(spark, odd, empty):
    rng = np.random.default_rng(2)
    rows, marks = [], []
    for i in range(400):
        words = [f"w{rng.integers(60)}" for _ in range(rng.integers(5, 80))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                words.insert(int(rng.integers(len(words))), str(rng.choice(["scum", "Vile!", "nastyish", "nastyous"])))
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks + [(9_999, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    weights = toxicity.train(docs, labels.where("doc_id < 300 or doc_id is null or doc_id = 9999"))
    got = toxicity.score(docs.where("doc_id >= 300"), weights).collect()
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 4 == 0) for r in got]) >= 0.95
    assert len(weights.keys) < 1500
    again = toxicity.train(docs.repartition(3), labels.where("doc_id < 300"))
    assert np.array_equal(again.keys, weights.keys)
    scored = toxicity.score(odd.withColumnRenamed("lang", "score"), weights).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
    assert toxicity.score(empty, weights).count() == 0
    clean = toxicity.drop_toxic(docs, weights)
    assert clean.columns == docs.columns and np.mean([r.doc_id % 4 == 0 for r in clean.collect()]) < 0.05
    blank = toxicity.train(docs, labels.limit(0))
    same = {r.score for r in toxicity.score(odd, blank).collect()}
    assert len(same) == 1 and same.pop() < 0.5


def test_quality_on_held_out_rows(docs, labels, odd, empty):
    ranker = ranking.train(docs, toxicity.learning_rows(labels, "doc_id", 5, 0))
    held = ranking.score(docs.where(remainder("doc_id", 5) == 0), ranker).join(labels, "doc_id").collect()
    assert auc([(r.quality, r.score) for r in held]) > 0.95
    assert np.mean([(r.score >= ranking.LIMIT) == (r.quality == 1) for r in held]) > 0.9
    scored = ranking.score(odd.withColumnRenamed("n_chars", "score"), ranker).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
    assert ranking.score(empty, ranker).count() == 0
    flat = ranking.score(odd, ranking.train(docs, labels.limit(0))).collect()
    assert len({r.score for r in flat}) == 1


def test_more_languages_than_a_handful(spark):
    """Seventy languages; each has letters of its own, and scripts without spaces are learned from anywhere."""
    rows = []
    for k in range(70):
        letters = [chr(0x4E00 + 40 * k + i) for i in range(30)]
        rng = np.random.default_rng(k)
        for i in range(10):
            body = "".join(rng.choice(letters[15:], 200))
            rows.append((k * 100 + i, "".join(letters[:15]) * 5 + body, f"l{k:02d}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs.where("doc_id % 100 < 8"), epochs=8)
    assert len(model.languages) == 70
    # Held-out texts without what every training text begins with.
    held = docs.where("doc_id % 100 >= 8").withColumn("text", F.expr("substr(text, 76)"))
    got = langid.predict(held, model).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.9
    few = langid.train(docs, sample_rows=140)
    assert len(few.languages) == 70


def test_very_long_words_in_bounded_memory(docs):
    import tracemalloc

    model = langid.train(docs.where("doc_id < 200"))
    reader = langid.Reader(model)
    rng = np.random.default_rng(1)
    word = "".join(rng.choice(list("abcdefghijß漢"), 3 * langid.LONG + 17))
    buckets, _ = langid.subwords([word])
    assert np.allclose(reader.mean(word), model.embeddings[buckets].mean(axis=0), atol=1e-5)
    both = reader.mean(f"some words {word} more")
    buckets, _ = langid.subwords(["some", "words", word, "more"])
    assert np.allclose(both, model.embeddings[buckets].mean(axis=0), atol=1e-5)
    text = word * 300
    tracemalloc.start()
    reader.predict(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(text) > 3_000_000 and peak < 60_000_000


def test_names_and_labels_that_clash(spark, docs, labels):
    some = docs.where("doc_id < 300")
    odd_names = some.withColumnsRenamed({"source": "__id", "n_chars": "__label"}).withColumn("id", F.lit(1)).withColumn("label", F.lit("x")).withColumn("doc", F.lit(2))
    marks = labels.where("doc_id < 300")
    # An id labelled both 0 and 1 counts as 0, in whatever order the rows come.
    flipped = marks.where("toxic = 0").limit(5).selectExpr("doc_id", "quality", "1 AS toxic")
    want = toxicity.train(some, marks)
    got = toxicity.train(odd_names, flipped.unionByName(marks), sample_per_label=10_000)
    assert np.array_equal(want.keys, got.keys) and np.allclose(want.values, got.values)
    assert langid.train(odd_names).languages == langid.train(some).languages
    one, two = ranking.train(some, marks), ranking.train(odd_names, marks)
    assert np.allclose(one.weights, two.weights)


def test_a_rare_feature_counts_as_much_as_it_was_learned_with():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 4))
    x[:, 3] = 0
    x[7, 3] = 1
    y = (x[:, 0] > 0).astype(int)
    ranker = ranking.fit_pairs(x, y, pairs=5000, epochs=5)
    far = np.zeros((2, 4))
    far[1, 3] = 1e6
    moved = np.diff(ranker.strength(far))[0]
    assert abs(moved) <= abs(ranker.weights[3]) * 2 * ranking.MOST_SPREADS + 1e-9
    # A plain refit of what is learned: the order of scores is that of the clipped, scaled features.
    clipped = np.clip((x - x.mean(axis=0)) / np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1), -8, 8) @ ranker.weights
    assert np.allclose(ranker.strength(x), clipped)


def test_all_pairs_of_good_and_bad_rows_count():
    rng = np.random.default_rng(8)
    y = (rng.random(700) < 0.8).astype(int)
    x = np.concatenate([rng.normal(size=(700, 5)) + 0.7 * y[:, None], rng.random((700, 2)) < 0.3], axis=1)
    ranker = ranking.fit_pairs(x, y, l2=1e-3)
    z = ranker.scaled(x)
    good, bad = z[y == 1], z[y == 0]

    def slope(w):
        lost = 1 / (1 + np.exp((good @ w)[:, None] - (bad @ w)[None, :]))
        return (bad.T @ lost.sum(axis=0) - good.T @ lost.sum(axis=1)) / lost.size + 1e-3 * w

    assert np.abs(slope(ranker.weights)).max() < 2e-3 < 2e-2 < np.abs(slope(np.zeros(7))).max()
    again = ranking.fit_pairs(x, y, l2=1e-3, pairs=50)
    assert np.allclose(again.weights, ranker.weights)

    # The threshold parts all rows as well as any cut between two of them.
    s = ranker.strength(x)
    right = lambda kept: kept[y == 1].mean() + (~kept[y == 0]).mean()
    best = max(right(s >= t) for t in s)
    assert abs(right(ranker.score(x) >= ranking.LIMIT) - best) < 1e-9


def test_every_labelled_text_is_learned_from(spark):
    rng = np.random.default_rng(9)
    texts = [" ".join(["word."] * int(rng.integers(1, 9)) + ["x"] * int(rng.integers(0, 3 + 3 * (i % 2)))) for i in range(7000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) AS quality")
    ranker = ranking.train(docs, labels)
    x = ranking.expand(np.array([ranking.measures(t.encode()) for t in texts]))
    assert np.allclose(ranker.mean, x.mean(axis=0)) and np.allclose(ranker.spread[x.std(axis=0) > 0.01], x.std(axis=0)[x.std(axis=0) > 0.01])
    same = ranking.fit_pairs(x, np.arange(7000) % 2)
    assert np.allclose(ranker.strength(x), same.strength(x), atol=1e-6) and abs(ranker.cut - same.cut) < 1e-3
    # Texts that were measured before give the same.
    found = ranking.measured(docs)
    assert np.allclose(ranking.train(found, labels, found="measures").strength(x), ranker.strength(x), atol=1e-6)
    one, two = ranking.score(docs, ranker), ranking.score(found, ranker, found="measures")
    assert two.columns == ["doc_id", "measures", "score"]
    assert {r.doc_id: r.score for r in one.collect()} == {r.doc_id: r.score for r in two.collect()}
