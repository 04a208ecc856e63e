import random
from collections import Counter, defaultdict

from tracklens.llm.line_dedup import dedup_lines

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    place = lambda d: (d is None, d or 0)
    owners = defaultdict(set)
    key = lambda x: x.strip(BLANKS).translate(LOWER)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                owners[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if len(owners.get(key(x), ())) < 2 or doc == min(owners[key(x)], key=place)
        ]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def found(df):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in df.collect())


def test_odd_rows_against_plain_loops(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(dedup_lines(odd)) == plain(rows)


def test_levels_and_batches_do_not_change_the_result(spark):
    rng = random.Random(3)
    lines = [f"line number {i} of the pool" for i in range(30)] + ["tiny", ""]
    rows = [(rng.randrange(60), "\n".join(rng.choices(lines, k=rng.randrange(1, 6)))) for _ in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for batches, fanout in ((1, 2), (7, 2), (6, 3)):
        assert found(dedup_lines(df, batches=batches, fanout=fanout)) == plain(rows)


def test_empty_table_and_clashing_columns(spark, empty):
    assert dedup_lines(empty).count() == 0
    df = spark.createDataFrame(
        [(1, "a line of ten", 5, "x", 1, 2), (2, "a line of ten", 6, "y", 3, 4)],
        "doc_id long, text string, n_lines long, k1 string, doc long, batch long",
    )
    rows = {r.doc_id: r for r in dedup_lines(df).collect()}
    assert rows[2].text == "" and rows[2].n_dropped == 1 and rows[2].k1 == "y" and rows[2].batch == 4
    assert rows[1].text == "a line of ten" and rows[1].n_lines == 1 and rows[1].doc == 1


def test_any_column_names(spark, odd):
    from tracklens.llm import line_dedup, mixing

    names = odd.withColumnsRenamed({"lang": "__doc", "n_chars": "__gone"}).withColumn("doc", odd.doc_id).withColumn("gone", odd.text)
    plain = line_dedup.dedup_lines(odd)
    got = line_dedup.dedup_lines(names)
    assert got.columns == [*names.columns, "n_lines", "n_dropped"]
    same = ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted(map(repr, got.select(same).collect())) == sorted(map(repr, plain.select(same).collect()))
    mixed = odd.withColumnsRenamed({"lang": "__d", "n_chars": "__n"}).withColumn("__s", odd.text).withColumn("copies", odd.doc_id)
    want = mixing.mix_sources(odd).select("doc_id", "text", "source").collect()
    assert sorted(map(repr, mixing.mix_sources(mixed).select("doc_id", "text", "source").collect())) == sorted(map(repr, want))
