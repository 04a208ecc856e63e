import hashlib
import random

import numpy as np

from tracklens.llm import queries, sketches


def plain_shingles(text):
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(rows):
    """(doc, n_chars, digest, true containments) with each document's next one, ties by text hash ignored."""
    out = []
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        mine = plain_shingles(text)

        def held(other, mine=mine):
            other = plain_shingles(other)
            return 1.0 if mine == other else len(mine & other) / max(1, len(mine))

        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), held(edited), held(after), len(mine)))
    return out


def test_whole_table(spark, small):
    rows = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    got = sorted(queries.QUERIES["op13_sketches"](spark, small).collect())
    want = plain(rows)
    assert [tuple(r[:3]) for r in got] == [w[:3] for w in want]
    texts = dict(rows)
    by_print = {}
    for r, w in zip(got, want, strict=True):
        by_print.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if w[5] < sketches.FLOOR // 2:
            # Few shingles: their own sketch is whole; only the other's may be cut.
            assert len(r.fingerprint) == 16 * w[5]
    assert all(len(prints) == 1 for prints in by_print.values())
    off = [r.near_edited - w[3] for r, w in zip(got, want, strict=True)]
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.12
    assert np.mean([abs(r.near_next - w[4]) for r, w in zip(got, want, strict=True)]) < 0.02


def test_odd_rows(odd, empty):
    clash = odd.withColumnsRenamed({"lang": "part", "source": "doc", "n_chars": "sketch"})
    got = sketches.fingerprints(clash.repartition(3)).collect()
    assert len(got) == odd.count()
    rows = sorted(((r.doc_id if r.doc_id is not None else -1), r.text or "") for r in odd.collect())
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_chars) for r in got) == sorted((d, len(t)) for d, t in rows)
    # Ids that occur once have one next document, but for those before a repeated id.
    want = {w[0]: w for w in plain(rows)}
    for r in got:
        if r.doc_id is not None and r.doc_id > 2 and r.doc_id != 12:
            assert (r.n_chars, r.edited_sha256) == want[r.doc_id][1:3]
    same = [r for r in got if r.doc_id in (1, 2)]
    assert len({r.fingerprint for r in same}) == 1
    bare = [r for r in got if r.doc_id in (3, 4, 5)]
    assert all(r.fingerprint == "" for r in bare) and all(r.near_edited == 1 for r in bare if r.n_chars == 0)
    assert sketches.fingerprints(empty).collect() == []


def test_order_does_not_depend_on_partitions(spark):
    rng = random.Random(3)
    rows = [(i * 7 - 50, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(30)))) for i in range(60)]
    rng.shuffle(rows)
    want = sorted(w[:3] for w in plain(sorted(rows)))
    for n in (1, 7):
        got = sketches.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(n)).collect()
        assert sorted(tuple(r[:3]) for r in got) == want
    one = sketches.fingerprints(spark.createDataFrame(rows[:1], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1


def test_unequal_documents_and_merging(spark):
    rng = random.Random(2)
    parts = [[f"w{rng.randrange(3000)}" for _ in range(400)] for _ in range(60)]
    whole = sketches.sketch(" ".join(w for p in parts for w in p).encode())
    held = [sketches.likeness(sketches.sketch(" ".join(p).encode()), whole)[0] for p in parts]
    assert min(held) > 0.99
    other = sketches.sketch(" ".join(parts[0][:200] + [f"v{i}" for i in range(200)]).encode(), floor=0)
    assert abs(sketches.likeness(other, whole, floor=0)[0] - 0.5) < 0.25
    # Shingles of texts together: the union of their sketches, floor included.
    texts = [("a", " ".join(p)) for p in parts[:5]] + [("b", "one two three four five six"), ("b", "x y"), (None, "z")]
    frame = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(texts)], "key string, text string, n int")
    made = frame.join(sketches.sketches(frame, "n"), "n").select("key", "sketch")
    got = {}
    for r in sketches.merged(made, "key").collect():
        got.setdefault(r["key"], []).append(r["hash"])
    for key in ("a", "b", None):
        every = np.unique(np.concatenate([sketches.shingle_hashes(t.encode()) for k, t in texts if k == key]))
        below = int((every < sketches.FRACTION * 2**63).sum())
        assert sorted(got[key]) == [int(x) for x in every[: max(below, sketches.FLOOR)]]


def test_estimates_are_unbiased():
    rng = random.Random(5)
    off = []
    for _ in range(200):
        a = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        b = a[: rng.randrange(20, 300)] + [f"w{rng.randrange(10**6)}" for _ in range(300)]
        true = len(plain_shingles(" ".join(a)) & plain_shingles(" ".join(b))) / 296
        off.append(sketches.likeness(sketches.sketch(" ".join(a).encode()), sketches.sketch(" ".join(b).encode()))[0] - true)
    assert abs(np.mean(off)) < 0.03
