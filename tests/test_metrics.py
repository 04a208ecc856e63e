import random

import pytest
from pyspark.sql import functions as F

from plain_metrics import plain_metrics
from tracklens.constants import METRIC_COLUMNS
from tracklens.functions import tokens
from tracklens.operators import (
    excerpt_ranges,
    excerpt_thirds,
    segment_metrics,
    segment_metrics_long,
    verdict,
    verdict_by_duration,
)
from tracklens.schemas import TRANSCRIPT_SCHEMA

SPACES = [chr(c) for c in range(0x10000) if chr(c).isspace()]


def seg(start, end, text, prob):
    return {"start": start, "end": end, "text": text, "no_speech_prob": prob}


def random_transcripts(n, seed=7):
    rng = random.Random(seed)
    alphabet = ["La", "la", "OH,", "don't", "사랑", "été", "ß", "😀", "x.y", "a\u200bb"]
    rows = []
    for i in range(n):
        segments = []
        for k in range(rng.randrange(0, 9)):
            words = [rng.choice(alphabet) for _ in range(rng.randrange(0, 12))]
            text = "".join(w + rng.choice(SPACES) * rng.randrange(1, 3) for w in words)
            prob = rng.choice([None, 0.0, 0.3, 0.59, 0.6, 0.61, 0.99])
            segments.append(seg(k * 10.0, k * 10 + rng.randrange(1, 80) / 8, text, prob))
        text = "".join(s["text"] for s in segments)
        rows.append((i, text, segments or rng.choice([None, []])))
    return rows


def test_tokens_split_on_every_unicode_space(spark):
    text = "".join(f"W{i}{c}" for i, c in enumerate(SPACES)) + "end"
    found = spark.createDataFrame([(text,)], "t string").select(tokens(F.col("t"))).first()[0]
    assert found == text.lower().split() and len(found) == len(SPACES) + 1


def test_nested_metrics_equal_plain_python(spark):
    rows = random_transcripts(300)
    df = segment_metrics(spark.createDataFrame(rows, TRANSCRIPT_SCHEMA))
    assert df.columns == METRIC_COLUMNS
    assert sorted(tuple(r) for r in df.collect()) == [plain_metrics(*r) for r in rows]


def test_long_metrics_equal_nested(spark):
    rows = random_transcripts(200, seed=11)
    nested = spark.createDataFrame(rows, TRANSCRIPT_SCHEMA)
    long = nested.select("track_id", F.posexplode("segments").alias("seg_no", "s")).select(
        "track_id",
        "seg_no",
        F.col("s.start").alias("start_s"),
        F.col("s.end").alias("end_s"),
        F.col("s.text").alias("text"),
        F.col("s.no_speech_prob").alias("no_speech_prob"),
    )
    whole = segment_metrics_long(long, nested.select("track_id", "text"))
    expected = [plain_metrics(*r) for r in rows]
    assert sorted(tuple(r) for r in whole.collect()) == expected
    only_seen = segment_metrics_long(long)
    assert sorted(tuple(r) for r in only_seen.collect()) == [e for e in expected if e[2]]


def test_no_segments_zero_everything_but_text_length(spark):
    rows = [(1, "abc", None), (2, "é😀", []), (3, None, None)]
    got = segment_metrics(spark.createDataFrame(rows, TRANSCRIPT_SCHEMA)).collect()
    assert [tuple(r) for r in got] == [
        (1, 3, 0, 0.0, 0.0, 0.0, 0, 0, 0),
        (2, 2, 0, 0.0, 0.0, 0.0, 0, 0, 0),
        (3, 0, 0, 0.0, 0.0, 0.0, 0, 0, 0),
    ]


def test_duration_is_the_last_end_not_the_largest(spark):
    rows = [(1, "x", [seg(0.0, 90.0, "a", 0.1), seg(5.0, 10.0, "b", 0.9)])]
    got = segment_metrics(spark.createDataFrame(rows, TRANSCRIPT_SCHEMA)).first()
    assert got["total_duration"] == 10.0
    assert got["speech_duration"] == 90.0 and got["speech_ratio"] == 9.0


def test_zero_duration_gives_ratio_zero(spark):
    rows = [(1, "x", [seg(0.0, 0.0, "a", None)])]
    got = segment_metrics(spark.createDataFrame(rows, TRANSCRIPT_SCHEMA)).first()
    assert got["speech_ratio"] == 0.0 and got["nsp06_seg_cnt"] == 1


def test_metrics_plan_has_no_shuffle_and_no_python(spark):
    df = segment_metrics(spark.createDataFrame([], TRANSCRIPT_SCHEMA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_verdicts(spark):
    words = spark.createDataFrame([(27,), (28,), (None,)], "nsp06_unique_word_cnt bigint")
    assert [r["verdict"] for r in verdict(words).collect()] == [False, True, None]
    rows = [
        (1, "", [seg(0.0, 20.0, "", 0.9)]),
        (2, "", [seg(0.0, 20.0, "", 0.9), seg(30.0, 30.5, "", 0.9)]),
        (3, "", None),
    ]
    judged = verdict_by_duration(spark.createDataFrame(rows, TRANSCRIPT_SCHEMA))
    assert [r["verdict"] for r in judged.collect()] == [False, True, False]


def plain_excerpt(a, keep, size):
    if len(a) < keep:
        return a
    first, second = len(a) // 3, 2 * len(a) // 3
    return a[first : first + size] + a[second : second + size]


def test_excerpt_equals_list_slicing(spark):
    rows = [(n, [float(i) for i in range(n)]) for n in range(1, 150)]
    df = spark.createDataFrame(rows, "track_id bigint, samples array<float>")
    cut = excerpt_thirds(df, "samples", rate=2, keep_s=15, slice_s=5)
    for r in cut.collect():
        assert r["samples"] == plain_excerpt(rows[r["track_id"] - 1][1], 30, 10)
    ranges = excerpt_ranges(
        df.withColumn("n", F.size("samples")), "n", rate=2, keep_s=15, slice_s=5
    )
    parts = {}
    for r in ranges.orderBy("track_id", "part").collect():
        got = rows[r["track_id"] - 1][1][r["start_sample"] : r["end_sample"]]
        parts.setdefault(r["track_id"], []).extend(got)
    assert all(parts[n] == plain_excerpt(a, 30, 10) for n, a in rows)


def test_excerpt_slices_must_fit(spark):
    df = spark.createDataFrame([(1, [1.0])], "track_id bigint, samples array<float>")
    with pytest.raises(ValueError):
        excerpt_thirds(df, "samples", keep_s=60, slice_s=30)


def test_a_segment_without_a_time_lasts_no_time(spark):
    rows = [(1, "x", [seg(0.0, None, "a", 0.1), seg(1.0, 5.0, "b", 0.1)]), (2, "y", [seg(None, 3.0, "c", 0.1)])]
    nested = spark.createDataFrame(rows, TRANSCRIPT_SCHEMA)
    long = nested.select("track_id", F.posexplode("segments").alias("seg_no", "s")).select(
        "track_id", "seg_no", F.col("s.start").alias("start_s"), F.col("s.end").alias("end_s"),
        F.col("s.text").alias("text"), F.col("s.no_speech_prob").alias("no_speech_prob"),
    )
    expected = [(1, 1, 2, 5.0, 4.0, 0.8, 2, 2, 2), (2, 1, 1, 3.0, 0.0, 0.0, 1, 1, 1)]
    assert sorted(map(tuple, segment_metrics(nested).collect())) == expected
    assert sorted(map(tuple, segment_metrics_long(long, nested).collect())) == expected
    assert [r["verdict"] for r in verdict_by_duration(nested, 3.5).collect()] == [True, False]


def test_long_metrics_read_the_segments_once(spark, tmp_path):
    import contextlib
    import io

    path = str(tmp_path / "segments")
    spark.sql("SELECT 1L AS track_id, 1 AS seg_no, 0D AS start_s, 2D AS end_s, 'a b' AS text, 0.1D AS no_speech_prob").write.parquet(path)
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        segment_metrics_long(spark.read.parquet(path)).explain()
    assert said.getvalue().count("FileScan") == 1 and "SortAggregate" not in said.getvalue()
