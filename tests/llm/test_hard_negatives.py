import math
import random

import duckdb
import numpy as np
import pytest

from tracklens.llm import hard_negatives, queries


def plain(rows, every=50, k=5, m=3):
    kept = {}
    for name, vector, label in rows:
        if name is None or label is None or vector is None or any(v is None or not math.isfinite(v) for v in vector):
            continue
        x = tuple(math.floor(256 * v) for v in vector)
        new = (str(label), np.array(x, "<f8").tobytes(), x)
        kept[name] = min(kept.get(name, new), new)
    out = set()
    for a, (label, _, x) in kept.items():
        if a % every:
            continue

        def score(b, x=x):
            return sum(p * q for p, q in zip(x, kept[b][2], strict=True))

        same = [b for b in kept if b != a and kept[b][0] == label and len(kept[b][2]) == len(x)]
        for p in sorted(same, key=lambda b: (-score(b), b))[:k]:
            inside = [b for b in kept if kept[b][0] != label and len(kept[b][2]) == len(x) and 50 * score(p) <= 100 * score(b) <= 95 * score(p)]
            for rank, b in enumerate(sorted(inside, key=lambda b: (-score(b), b))[:m], 1):
                out.add((a, p, rank, b, score(p), score(b)))
    return out


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_sql(spark, sf):
    got = rows_of(queries.QUERIES["op11_hard_negatives"](spark, f"/root/testdata/{sf}"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/{sf}/embeddings.parquet'")
    assert got and got == set(con.execute(queries.ORACLE["op11_hard_negatives"]).fetchall())


def test_odd_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(3)], rng.randrange(3)) for i in range(120)]
    rows += [(0, [1.0, 1.0, 1.0], 2), (50, [0.0, 0.0, 0.0], 1), (200, None, 1), (250, [1.0, None, 2.0], 1), (300, [1.0, float("nan"), 0.0], 1)]
    rows += [(350, [float("inf"), 0.0, 0.0], 0), (None, [1.0, 1.0, 1.0], 0), (400, [1.0, 0.5, 0.5], None), (450, [1.0, 1.0], 0), (451, [1.0, 0.5], 0)]
    rows += [(452, [0.6, 0.7], 1), (500, [], 0), (501, [], 0), (502, [], 1), (600, [0.0, 0.0, 0.0], 0), (3, [0.5, 0.5, 0.5], 1)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, block string, batch int")
    want = plain(rows)
    assert any(r[0] == 0 for r in want) and any(r[0] == 500 for r in want) and any(r[0] == 450 for r in want)
    for values, batch in ((1 << 19, 1024), (24, 2)):
        assert rows_of(hard_negatives.mine(frame, block_values=values, batch_rows=batch)) == want
    assert hard_negatives.mine(frame.limit(0)).collect() == []


def test_components_beyond_doubles(spark):
    rng = random.Random(6)
    rows = [(i, [float(rng.randrange(10**6)) * 3 + rng.random() for _ in range(4)], i % 3) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = plain(rows)
    assert want and max(r[4] for r in want) > 1 << 53
    assert rows_of(hard_negatives.mine(frame)) == want


def test_reading_stops_early_and_keeps_ties():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 4))
    x = np.floor(64 * (centres[rng.integers(20, size=4000)] + 0.01 * rng.normal(size=(4000, 4))))
    block = hard_negatives.Block(x, np.arange(4000), np.zeros(4000, np.int64))
    read = []
    for a in x[:40]:
        fit = rng.random(4000) < 0.7
        scores = x @ a
        order = [(int(scores[i]), int(i)) for i in sorted(np.flatnonzero(fit), key=lambda i: (-scores[i], i))]
        top = order[0][0]
        windows = [None, (50, 95, top), (10, 20, top)]
        want = [order[:5], *([f for f in order if w[0] * top <= 100 * f[0] <= w[1] * top][:5] for w in windows[1:])]
        got, n = block.search(a, fit, windows[:1], 5)
        read.append(n)
        assert got == want[:1]
        assert block.search(a, fit, windows, 5)[0] == want
    assert np.mean(read) < 2000
