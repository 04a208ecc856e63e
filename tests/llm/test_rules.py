import re

from tracklens.llm.quality_rules import POLICIES, RULES, ablations, measure, passes, quality_ledger

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words, text = WORD.findall(text or ""), text or ""
    spans = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = {i + k for i, s in enumerate(spans) if spans.count(s) > 1 for k in range(8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(hit))


def test_measures_against_plain_loops(odd):
    for r in odd.collect():
        if r.doc_id != 8:  # the plain form is quadratic
            assert measure((r.text or "").encode())[:5] == plain(r.text), r.doc_id


def test_ledger_rows_and_policies(odd, empty):
    ledger = quality_ledger(odd)
    assert ledger.count() == odd.count() and quality_ledger(empty).count() == 0
    by = {r.doc_id: r for r in ledger.withColumn("ok", passes("v1")).collect()}
    assert by[3].n_words == 0 and by[3].failures & 1 and not by[3].ok
    assert by[11].failures & 2 and by[1].failures == 0 and by[9].failures & (1 << RULES["word_length"])


def test_ablations_count_by_bits(spark):
    df = spark.createDataFrame([(0,), (1,), (3,), (2,), (2,), (256,)], "failures long")
    rows = {r.rule: (r.n_failed, r.n_failed_alone, r.n_kept_without) for r in ablations(df, "v1").collect()}
    assert POLICIES["v1"] == 3
    assert rows == {"few_words": (2, 1, 3), "repeated_words": (3, 2, 4)}


def test_clashing_columns(odd):
    clash = odd.withColumnsRenamed({"lang": "n_words", "source": "failures"})
    assert quality_ledger(clash).count() == odd.count()
