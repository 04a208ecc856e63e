import random

import numpy as np
import pytest
from pyspark.sql import types as T

from tracklens.llm import cover_tree as ct

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), T.StructField("tag", T.StringType()),
])


def plain(rows, least=0.93):
    units = []
    for _, v, label in rows:
        x = np.array([np.nan if c is None else c for c in v or []], np.float64)
        fine = label is not None and len(x) and np.isfinite(x).all() and np.abs(x).max() > 0
        units.append(x / np.linalg.norm(x) if fine else None)
    n = len(rows)
    linked = [[] for _ in range(n)]
    for i in range(n):
        for j in range(n):
            a, b = units[i], units[j]
            if i != j and a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= least:
                linked[i].append(j)
    part = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            low = min([part[i], *(part[j] for j in linked[i])])
            changed |= low != part[i]
            part[i] = low
    least_id = {}
    for i in range(n):
        ids = [rows[k][0] for k in range(n) if part[k] == part[i] and rows[k][0] is not None]
        least_id[i] = min(ids, default=None)
    return sorted(((rows[i][0], len(linked[i]), least_id[i], rows[i][0] == least_id[i]) for i in range(n)), key=str)


def found(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def clouds(seed, n, spread=0.12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(n):
        c = centres[rng.integers(6)]
        v = c / np.linalg.norm(c) + rng.normal(size=8) * spread * rng.random()
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3)) if i % 17 else None))
    return rows


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, None, 1), (4, [0.0, 0.0], 1),
        (5, [1.0, None], 1), (6, [float("nan"), 1.0], 1), (7, [float("inf"), 1.0], 1), (8, [1.0, 0.0], None),
        (9, [1.0, 0.0], 2), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.01], 1), (12, [0.0, 1.0], 1),
        (13, [3e38, 0.0], 1), (14, [1e-40, 0.0], 1),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert found(ct.embedding_components(df)) == plain(rows)
    assert ct.embedding_components(df.limit(0)).count() == 0
    kept = ct.keep_one(df.where("vec_id in (1, 2)"))
    assert kept.columns == df.columns and [r.vec_id for r in kept.collect()] == [1]


@pytest.mark.parametrize("cell", [4096, 40])
def test_clouds_against_all_pairs(spark, cell):
    rows = clouds(cell, 260) + [(1000 + i, [1.0] * 8, 1) for i in range(30)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, None) for r in rows], SCHEMA)
    assert found(ct.embedding_components(df, cell_rows=cell, most_pivots=5)) == plain(rows)


def test_tree_is_nested_and_covers():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 5))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[10] = x[11]

    def rows(node):
        return [node.centre] if node.children is None else [r for c in node.children for r in rows(c)]

    top = ct.cover_tree(x)
    assert sorted(rows(top)) == list(range(300))
    todo = [top]
    while todo:
        node = todo.pop()
        if node.children:
            assert node.children[0].centre == node.centre
            assert all(np.linalg.norm(x[r] - x[node.centre]) <= node.radius + 1e-6 for r in rows(node))
            assert all(c.radius <= node.radius / 2 + 1e-9 for c in node.children)
            todo += node.children


@pytest.mark.parametrize("step", [6e-8, 1e-9, 1e-12, 1e-40])
def test_near_equal_vectors_end(step):
    """Vectors within rounding of one another, against all pairs."""
    for seed in range(60):
        rng = np.random.default_rng(seed)
        centre = rng.normal(size=64)
        x = np.repeat(centre[None], 2 if seed else 1000, axis=0)
        x[np.arange(len(x)), rng.integers(64, size=len(x))] += step * rng.integers(1, 9, size=len(x))
        x /= np.sqrt((x * x).sum(axis=1))[:, None]
        x = np.unique(x, axis=0)
        links, parts = ct.linked(x, np.arange(len(x)), None, np.ones(len(x), np.int64), 0.93)
        assert (links == len(x) - 1).all()
        assert (parts.root(np.arange(len(x))) == 0).all()


def test_neighbours_in_single_precision(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=64).astype(np.float32)
    rows = []
    for i in range(120):
        v = base.copy()
        v[i % 64] = np.nextafter(v[i % 64], np.float32(9 if i % 2 else -9))
        rows.append((i, [float(c) for c in v], 1))
    df = spark.createDataFrame([(*r, None) for r in rows], SCHEMA)
    assert found(ct.embedding_components(df, cell_rows=50, most_pivots=3)) == plain(rows)
