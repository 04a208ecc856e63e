from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tests.llm.test_lines import plain as plain_lines
from tests.llm.test_mixing import targets
from tests.llm.test_simhash import parts, plain_print
from tracklens.llm import toxicity
from tracklens.llm.queries import MODEL_PATH, ORACLE, QUERIES


def test_stages_run_and_keep_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    sizes, now = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, small)
        assert now.columns == docs.columns, name
        sizes.append(now.count())
    assert sizes[1] <= sizes[0] and sizes[2] == sizes[1] and sizes[3] <= sizes[2]
    out = corpus_pipeline.run(spark, small)
    rows = out.collect()
    assert len(rows) == sizes[-1] and all(r.n_tokens == len(r.tokens) for r in rows)


def test_every_operator_is_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLE) < set(QUERIES)


def test_rows_against_a_plain_chain(spark, small):
    """Each stage in plain Python on what the one before left; tokens by the public library."""
    docs, labels = (spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.train(docs, toxicity.learning_rows(labels, "doc_id", 5, 0))
    cache = toxicity.Words()
    rows = {r.doc_id: r for r in docs.collect()}
    texts = {d: r.text for d, r in rows.items() if model.score(toxicity.features(None if r.text is None else r.text.encode(), cache)) < 0.5}
    assert 0.5 * len(rows) < len(texts) < len(rows)
    texts = {d: t for d, _, _, t in plain_lines(list(texts.items()))}
    prints = {d: plain_print(t) for d, t in texts.items()}
    values = sorted(set(prints.values()))
    root = parts(values, [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 4])
    heads = {}
    for d in sorted(texts):
        heads.setdefault(root[prints[d]], d)
    texts = {d: texts[d] for d in heads.values()}
    out = corpus_pipeline.run(spark, small).collect()
    copies = Counter(r.doc_id for r in out)
    assert set(copies) <= set(texts) and max(copies.values()) <= 3
    assert all(r.text == texts[r.doc_id] and r.source == rows[r.doc_id].source and r.lang == rows[r.doc_id].lang for r in out)
    sizes, taken, most = defaultdict(int), Counter(), Counter()
    for d, t in texts.items():
        n, source = len(t.encode().split()), rows[d].source
        sizes[source] += n
        taken[source] += n * copies[d]
        most[source] = max(most[source], n)
    want = targets(sizes)
    assert all(abs(taken[s] - want[s]) <= most[s] + 1e-6 for s in sizes)
    judge = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=MODEL_PATH)
    assert all(r.tokens == judge.encode(r.text) and r.n_tokens == len(r.tokens) for r in out)
