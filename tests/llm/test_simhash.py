import random
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tracklens.llm import simhash
from tracklens.llm.components import connected_components


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def parts(nodes, pairs):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def plain_components(rows):
    prints = [(d, plain_print(t)) for d, t in rows]
    values = sorted({f for _, f in prints})
    near = [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 4]
    root = parts(values, near)
    least = defaultdict(list)
    for d, f in prints:
        least[root[f]].append(d)
    low = {r: min((d for d in ds if d is not None), default=None) for r, ds in least.items()}
    return sorted(((d, f, low[root[f]]) for d, f in prints), key=str)


def found(df):
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in df.collect()), key=str)


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(simhash.simhash_components(odd)) == plain_components(rows)
    assert simhash.simhash_components(empty).count() == 0


def test_near_copies_against_all_pairs(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(simhash.simhash_components(docs)) == plain_components(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in plain_components(rows)}


def test_large_buckets_lose_no_link(spark):
    rng = random.Random(5)
    values = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(60):
            v = base
            for b in rng.sample(range(64), rng.randrange(4)):
                v ^= 1 << b
            values.add(v)
    values |= {rng.getrandbits(64) for _ in range(300)}
    signed = {v - (1 << 64) if v >> 63 else v for v in values}
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 4]
    want = {n: r for n, r in parts(signed, near).items() if any(n in p for p in near)}
    for limit in (4096, 16):
        roots = connected_components(simhash.close_edges(df, 4, bucket_rows=limit))
        assert {r.node: r.root for r in roots.collect()} == want


def test_carry_save_counters_against_popcounts():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 64, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 64).astype(np.uint64)) ^ rng.integers(0, 200, 64).astype(np.uint64)
    planes = simhash._planes(b.reshape(1, 64))
    masks = np.uint64(0) - ((a.reshape(1, 64, 1) >> np.arange(64, dtype=np.uint64)) & np.uint64(1))
    for radius in (0, 1, 4, 7, 15):
        alive, words = simhash.close_lanes(planes, masks, radius)
        got = {(i, j) for i in range(64) for j in range(64) if len(alive) and int(words[0, i]) >> j & 1}
        assert got == {(i, j) for i in range(64) for j in range(64) if (int(a[i]) ^ int(b[j])).bit_count() <= radius}


def test_clashing_columns(odd):
    clash = odd.withColumnsRenamed({"lang": "fp", "source": "component_id", "n_chars": "key"})
    assert simhash.simhash_components(clash).count() == odd.count()
    assert simhash.keep_one(clash.withColumn("__x", F.lit(1))).columns[-1] == "__x"


def test_one_row_of_each_component_stays(spark):
    """Repeated rows and ids, null ids, and column names that operators use inside."""
    text, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    near = text.replace("w30", "x30")
    rows = [(1, text, 1), (1, text, 2), (2, text, 3), (1, other, 4), (5, other, 5), (1, near, 6), (None, "alone here", 7), (None, "alone here", 8), (9, "", 9), (8, None, 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __kept int")
    groups = simhash.simhash_components(df).collect()
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    got = kept.collect()
    prints = {plain_print(t) for _, t, _ in rows}
    root = parts(prints, [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4])
    assert len(got) == len({root[plain_print(t)] for _, t, _ in rows}) and len(groups) == len(rows)
    by = {}
    for d, t, _ in rows:
        by.setdefault(root[plain_print(t)], []).append((d is None, d, t or ""))
    assert {(r.doc_id, root[plain_print(r.text)]) for r in got} == {(min(v, key=lambda x: (x[0], x[1] or 0))[1], k) for k, v in by.items()}
    assert simhash.keep_one(df.limit(0)).collect() == []
