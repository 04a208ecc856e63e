import random
import re
import zlib
from collections import Counter

import pytest

from tracklens.llm import queries, spelling


def plain_words(rows, typo_every=31):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if typo_every and h % typo_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_variants(counts, ratio=10):
    by_rest = {}
    for w in counts:
        for key in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            by_rest.setdefault(key, set()).add(w)
    found = {w: set() for w in counts}
    for group in by_rest.values():
        for a in group:
            found[a] |= {b for b in group if near(a, b)}
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda b: (-counts[b], b), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(found[w]), counts.get(form[w])))
    return out


def rows_of(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    want = plain_variants(plain_words(rows))
    assert any(r[4] for r in want) and any(r[1] for r in want)
    assert rows_of(queries.QUERIES["op12_spelling"](spark, small)) == want


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = plain_variants(plain_words(rows))
    clash = odd.withColumnsRenamed({"lang": "word", "source": "n", "n_chars": "__part"})
    assert want and rows_of(spelling.spelling_variants(clash, typo_every=31)) == want
    assert spelling.spelling_variants(empty).collect() == []
    with pytest.raises(ValueError):
        spelling.spelling_variants(odd, least=3)


def test_chains_ties_and_hot_keys(spark):
    """Few letters, so that many words meet under one key, grams repeat in a word, and forms follow one another."""
    rng = random.Random(4)
    words = {"".join(rng.choice("abß" if i % 5 else "aaé") for _ in range(rng.randrange(5, 9))) for i in range(1500)}
    counts = {w: rng.choice([2, 2, 3, 20, 30, 200, 2000, 2000, 30_000]) for w in sorted(words)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = plain_variants(counts)
    assert any(r[1] != r[2] and r[1] for r in want)
    for bucket in (8, 2048):
        assert rows_of(spelling.variants(frame, bucket_rows=bucket)) == want


def test_cheapest_disjoint_pivots():
    rng = random.Random(1)
    for _ in range(300):
        grams = [(i, rng.randrange(9)) for i in sorted(rng.sample(range(12), rng.randrange(3, 9)))]
        best = min(a[1] + b[1] for a in grams for b in grams if b[0] - a[0] >= 2)
        one, two = spelling.pivots(grams)
        cost = dict(grams)
        assert two - one >= 2 and cost[one] + cost[two] == best


def test_each_pair_once(spark):
    words = ["banana", "bananna", "banaana", "bandana", "cabana", "bananaa"]
    frame = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    pairs = sorted(tuple(sorted((r.a, r.b))) for r in spelling.near_pairs(frame).collect())
    assert pairs == sorted((a, b) for a in words for b in words if a < b and near(a, b))
