import numpy as np
import pytest

from tracklens.llm import toxicity


@pytest.fixture(scope="module")
def mixed(spark):
    """One toxic row in ten; half the toxic and one clean row in twenty hold the telling word."""
    rng = np.random.default_rng(4)
    rows, marks = [], []
    for i in range(3000):
        toxic = i % 10 == 0
        words = [f"w{rng.integers(40)}" for _ in range(rng.integers(5, 30))]
        if rng.random() < (0.5 if toxic else 0.05):
            words.append("scum")
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_cut_does_not_move_when_both_classes_are_capped(mixed):
    docs, labels = mixed
    whole = toxicity.train(docs, labels)
    capped = toxicity.train(docs, labels, sample_per_label=200)
    assert abs(whole.bias - np.log(300 / 2700)) < 1
    assert abs(capped.bias - whole.bias) < 0.7  # without the shift they are 2.2 apart
    plain = toxicity.score(docs.where("doc_id % 10 > 0"), capped).where("score >= 0.5").count()
    assert plain < 270
    # One class alone at its bound counts too: 300 of 300 and 400 of 2,700.
    assert abs(toxicity.train(docs, labels, sample_per_label=400).bias - whole.bias) < 0.7


def test_odds_shift():
    assert toxicity.odds_shift({0: 90, 1: 10}, {0: 90, 1: 10}) == 0
    assert np.isclose(toxicity.odds_shift({0: 90, 1: 10}, {0: 10, 1: 10}), np.log(1 / 9))
    assert toxicity.odds_shift({0: 90}, {0: 10}) == toxicity.odds_shift({}, {}) == 0
