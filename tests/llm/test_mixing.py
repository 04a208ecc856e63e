from collections import Counter, defaultdict

import pytest

from tracklens.llm.mixing import mix_sources, pivot, plan_copies


def targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not full:
            return out | {s: weight[s] * level for s in open_}
        for s in full:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_odd_rows(odd):
    rows = plan_copies(odd).collect()
    sizes = defaultdict(int)
    for r in odd.collect():
        sizes[r.source] += len((r.text or "").encode().split())
    want = targets(sizes)
    assert sum(r.n_rows for r in rows) == odd.count()
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3
    assert {(r.doc, r.source, r.hash): r.copies for r in rows} == {
        (r.doc, r.source, r.hash): r.copies for r in plan_copies(odd.repartition(5)).collect()
    }


def test_each_source_comes_within_one_document(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    taken, target, most = Counter(), {}, Counter()
    for r in plan_copies(docs).collect():
        taken[r.source] += r.size * r.copies * r.n_rows
        target[r.source] = r.target
        most[r.source] = max(most[r.source], r.size * r.n_rows)
    for s, t in target.items():
        assert abs(taken[s] - t) <= most[s] + 1e-6


def test_tree_over_many_buckets(spark, monkeypatch):
    from tracklens.llm import mixing

    monkeypatch.setattr(mixing, "BUCKET_ROWS", 5)
    monkeypatch.setattr(mixing, "TREE_FANOUT", 4)
    rows = [(i, "w " * (1 + i % 7), "hot" if i % 3 else "b") for i in range(300)]
    plan = plan_copies(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(plan) == 300
    for s in ("hot", "b"):
        mine = [r for r in plan if r.source == s]
        assert abs(sum(r.size * r.copies for r in mine) - mine[0].target) <= 7


def test_pivot_keeps_words_and_expectation():
    items = [(i, 1 + i % 5, 0.3) for i in range(101)]
    settled, held = pivot(items, 0)
    words = dict((k, w) for k, w, _ in items)
    total = sum(words[k] * up for k, up in settled) + (held[1] * held[2] if held else 0)
    assert total == pytest.approx(sum(w * p for _, w, p in items))
    ups = Counter()
    for level in range(400):
        ups.update(k for k, up in pivot(items, level)[0] if up)
    assert sum(ups[k] for k in range(50)) / (400 * 50) == pytest.approx(0.3, abs=0.03)


def test_mixed_rows_keep_their_columns(spark, odd, empty):
    assert mix_sources(empty).count() == 0 and mix_sources(empty).columns == empty.columns
    want = {(r.doc, r.source, r.hash): r.copies * r.n_rows for r in plan_copies(odd).collect()}
    mixed = mix_sources(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(want.values())
    clash = odd.withColumnsRenamed({"lang": "size", "n_chars": "copies"})
    assert mix_sources(clash).count() == mixed.count()


def test_all_texts_empty(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.target, r.copies) for r in plan_copies(df).collect()] == [(0.0, 0), (0.0, 0)]
