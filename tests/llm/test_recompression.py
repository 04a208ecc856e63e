import random
from collections import Counter

import numpy as np
import pytest

from tracklens.llm import recompression
from tracklens.llm.recompression import Chunk, WordNames, remove_repeats


def plain(rows, window=20):
    place = lambda d: (d is None, d or 0)
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, words in texts:
        for i in range(len(words) - window + 1):
            span = tuple(words[i : i + window])
            at = (place(d), i)
            first[span] = min(first.get(span, at), at)
    out = []
    for d, words in texts:
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] != (place(d), i):
                gone.update(range(i, i + window))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((d, len(words), len(gone), b" ".join(kept).decode()))
    return Counter(out)


def found(df):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in df.collect())


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(remove_repeats(odd)) == plain(rows)
    assert remove_repeats(empty).count() == 0


@pytest.mark.parametrize("chunk", [1 << 19, 150])
def test_shared_passages_runs_and_periods(spark, monkeypatch, chunk):
    monkeypatch.setattr(recompression, "CHUNK_WORDS", chunk)
    rng = random.Random(chunk)
    passages = [[f"w{rng.randrange(40)}" for _ in range(n)] for n in (19, 20, 21, 35, 60)]
    passages += [["a"] * 30, ["a", "b"] * 20, ["a", "a", "b"] * 15]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(5)):
            words += [f"u{rng.randrange(5000)}" for _ in range(rng.randrange(12))]
            p = rng.choice(passages)
            cut = rng.randrange(4)
            words += p[cut : len(p) - rng.randrange(4)]
        rows.append((rng.randrange(100) if i % 9 else None, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(remove_repeats(df.repartition(7))) == plain(rows)


def test_windows_point_to_the_same_symbol_wherever_they_stand():
    rng = random.Random(2)
    vocabulary = [f"v{i}".encode() for i in range(6)]
    texts = [[rng.choice(vocabulary) for _ in range(rng.randrange(300))] for _ in range(40)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    for t in texts:
        at = rng.randrange(len(t) + 1)
        t[at:at] = passage
    chunk = Chunk(texts, WordNames(), 20, 2)
    words = [w for t in texts for w in t]
    key = {}
    for p, x in zip(chunk.windows, chunk.points, strict=True):
        pointed = (int(chunk.key[x]), int(x - p)) if x >= 0 else None
        assert key.setdefault(tuple(words[p : p + 20]), pointed) == pointed
    assert np.mean(chunk.points >= 0) > 0.9


def test_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(25))
    df = spark.createDataFrame(
        [(1, text, 7, "a", "b"), (2, "x " + text, 8, "c", "d")],
        "doc_id long, text string, n_words long, doc string, packed string",
    )
    rows = {r.doc_id: r for r in remove_repeats(df).collect()}
    assert rows[2].text == "x" and rows[2].n_removed == 25 and (rows[2].doc, rows[2].packed) == ("c", "d")
