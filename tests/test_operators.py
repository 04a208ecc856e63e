import pytest
from pyspark.sql import functions as F

from tracklens import operators as ops


def ids(df):
    return sorted((r["track_id"] for r in df.collect()), key=lambda x: (x is None, x))


def tracks(spark):
    rows = [
        (1, [3, 50]),  # hit
        (2, [50, 51]),  # sure miss
        (3, None),  # no list
        (4, [50, None]),  # unknown
        (5, [3, None]),  # hit all the same
        (6, []),  # empty list
    ]
    return spark.createDataFrame(rows, "track_id bigint, style_id_list array<int>")


def test_strict_exclusion_drops_unknown(spark):
    assert ids(ops.exclude_styles_strict(tracks(spark), [3])) == [2, 3, 6]


def test_lenient_exclusion_keeps_unknown(spark):
    assert ids(ops.excluded_track_ids(tracks(spark), [3])) == [1, 5]
    left = ops.anti_excluded(tracks(spark), ops.excluded_track_ids(tracks(spark), [3]))
    assert ids(left) == [2, 3, 4, 6]


def test_popularity_and_flags_fail_on_null(spark):
    df = spark.createDataFrame([(1, 0.2), (2, 0.19), (3, None)], "track_id bigint, pop_score double")
    assert ids(ops.min_popularity(df)) == [1]
    rows = [(1, "N", "N"), (2, "N", None), (3, None, "N"), (4, "Y", "N"), (5, "N", "Y")]
    df = spark.createDataFrame(rows, "track_id bigint, lyric_yn string, sync_lyric_yn string")
    assert ids(ops.without_lyrics(df)) == [1]


def test_genre_filters_differ_on_longer_ids(spark):
    df = spark.createDataFrame([(1, "119,3"), (2, "19"), (3, "3,22"), (4, None)], "track_id bigint, genre_id_array string")
    assert ids(ops.genre_substring(df)) == [1, 2, 3]
    assert ids(ops.genre_any(df)) == [2, 3]


@pytest.mark.parametrize(
    "mode,expected", [("fixed", [59.98, -3.7, None, 12.0]), ("faithful", [59, -3, None, 12])]
)
def test_cast_modes(spark, mode, expected):
    big = "3000000000" if mode == "fixed" else "2147483647"
    rows = [("1", "59.98", "0.5"), ("2", "-3.7", "x"), ("x", "abc", None), (big, "12", "1")]
    df = spark.createDataFrame(rows, "track_id string, total_duration string, speech_ratio string")
    got = ops.cast_metrics(df, mode=mode).collect()
    assert [r["total_duration"] for r in got] == expected
    assert [r["track_id"] for r in got] == [1, 2, None, int(big)]
    assert [r["speech_ratio"] for r in got] == [0.5, None, None, 1.0]
    with pytest.raises(ValueError):
        ops.cast_metrics(df, mode="other")


def test_tiers_treat_null_as_n(spark):
    df = spark.createDataFrame([(28,), (15,), (None,)], "nsp06_unique_word_cnt bigint")
    got = [tuple(r)[1:] for r in ops.tier_flags(df).collect()]
    assert got == [("Y",) * 5, ("N", "N", "N", "Y", "Y"), ("N",) * 5]


def test_stat_projection_keeps_long_text(spark):
    df = spark.createDataFrame(
        [("7", "t" * 150, "a", "g", "N", 3, 2)],
        "track_id string, track_title string, artist_array string, genre_array string,"
        "lyric_yn string, nsp06_word_cnt int, nsp06_unique_word_cnt int",
    )
    row = ops.stat_projection(df).first()
    assert row["track_id"] == 7 and len(row["track_title"]) == 150


def test_not_processed_ignores_null_on_both_sides(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "track_id bigint")
    done = spark.createDataFrame([(2,), (2,), (None,)], "track_id bigint")
    assert ids(ops.not_processed(left, done)) == [1, None]


def test_keep_without_lyrics(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (3,), (4,), (None,)], "track_id bigint")
    lyric = spark.createDataFrame(
        [(1, "N"), (1, "N"), (1, "Y"), (2, "Y"), (3, None), (None, "Y")],
        "track_id bigint, lyric_yn string",
    )
    kept = ops.keep_without_lyrics(left, lyric)
    plain = (
        left.join(lyric, "track_id", "left").fillna("N", ["lyric_yn"]).filter("lyric_yn = 'N'")
    )
    assert ids(kept) == [1, 1, 3, 4, None]
    assert kept.agg(F.sum("lyric_rows")).first()[0] == plain.count()


def test_dedupe_prefers_newest_then_most_words(spark):
    rows = [
        (1, 9, 9, "20240101"),
        (1, 5, 4, "20240102"),
        (1, 5, 5, "20240102"),
        (2, None, 1, "20240101"),
        (2, 0, 0, "20240101"),
        (3, 1, 1, None),
    ]
    df = spark.createDataFrame(
        rows, "track_id bigint, nsp06_word_cnt int, nsp06_unique_word_cnt int, yyyymmdd string"
    )
    got = ops.dedupe_tracks(df)
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == [rows[2], rows[4], rows[5]]


def test_artist_lists(spark):
    rows = [
        (1, "b", "VOCAL"), (1, "a", "VOCAL"), (1, "b", "VOCAL"), (1, None, "VOCAL"),
        (2, None, "VOCAL"), (3, "x", "COMPOSER"),
    ]
    df = spark.createDataFrame(rows, "track_id bigint, artist_text string, artist_role_type string")
    got = {r["track_id"]: r["artist_array"] for r in ops.vocal_artists(df).collect()}
    assert got == {1: "a,b,b", 2: ""}


def test_genre_lists(spark):
    pairs = spark.createDataFrame(
        [(1, 10), (1, 9), (1, 10), (2, 11), (3, 99), (4, None), (None, 9)],
        "track_id bigint, svc_genre_id bigint",
    )
    genre = spark.createDataFrame(
        [(9, "Jazz"), (10, "OST"), (11, None)], "svc_genre_id bigint, svc_genre_nm string"
    )
    lists = {r["track_id"]: r["genre_array"] for r in ops.track_genres(pairs, genre).collect()}
    assert lists == {1: "Jazz,OST,OST", 2: "", None: "Jazz"}
    agg = {r["track_id"]: tuple(r)[1:] for r in ops.genre_listagg(pairs, genre).collect()}
    assert agg == {1: ("Jazz,OST,OST", "9,10,10"), 2: (None, "11"), None: ("Jazz", "9")}


def test_verdict_counts_has_both_verdicts(spark):
    df = spark.createDataFrame([(True,), (True,), (None,)], "verdict boolean")
    assert {r["verdict"]: r["n"] for r in ops.verdict_counts(df).collect()} == {True: 2, False: 0}


def test_verdict_lines(spark):
    lines = [
        "loading track 5",
        "INFO Voice detected: {'track_id': 11, 'words': 40}",
        'Voice is not detected: {"words": 2, "track_id": "12"}',
        "Voice detected: {'track_id': 11, 'words': 40}",
        "Voice is not detected: {'words': 3}",
        "Voice detected: {'track_id': 1} Voice is not detected: {'track_id': 2}",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [tuple(r) for r in ops.parse_verdict_lines(df).collect()]
    assert got == [(11, True), (12, False), (11, True), (None, False), (1, True)]


def test_top_tracks_breaks_ties_by_id(spark):
    df = spark.createDataFrame([(3, 0.9), (1, 0.9), (2, 1.0), (4, None)], "track_id bigint, pop_score double")
    assert [r["track_id"] for r in ops.top_tracks(df, 2).collect()] == [2, 1]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Seoul", "America/Los_Angeles"])
def test_run_date_in_seoul_under_any_session_zone(spark, zone):
    # The instants 14:59:59 and 15:00:00 UTC, and one before 1970; then UTC clocks.
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        instants = spark.sql("SELECT timestamp_seconds(x) AS ts FROM VALUES (1704121199), (1704121200), (-1.5) v(x)")
        assert instants.dtypes == [("ts", "timestamp")]
        got = sorted(r["run_date"] for r in ops.with_run_date(instants, "ts").collect())
        assert got == ["19700101", "20240101", "20240102"]
        clocks = spark.sql("SELECT timestamp_ntz'2024-01-01 14:59:59' AS ts UNION ALL SELECT timestamp_ntz'2024-01-01 15:00:00'")
        got = sorted(r["run_date"] for r in ops.with_run_date(clocks, "ts").collect())
        assert got == ["20240101", "20240102"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scoring_goes_on_after_a_failure(spark):
    def make_scorer():
        import os

        made = os.urandom(8).hex()

        def score(row):
            if row["x"] == 13:
                raise RuntimeError("bad track")
            return {"y": row["x"] * 2.0, "made": made}

        return score

    df = spark.range(0, 40, 1, 4).select(F.col("id").alias("track_id"), F.col("id").alias("x"))
    scored = ops.score_batches(
        df, ops.row_by_row(make_scorer), "y double, made string", partitions=4
    ).cache()
    ok, errors = ops.split_errors(scored)
    assert ids(ok) == [i for i in range(40) if i != 13] and "error" not in ok.columns
    assert [tuple(r) for r in errors.collect()] == [(13, None, None, "RuntimeError: bad track")]
    # One scorer per worker process, however many batches and tasks it sees.
    assert ok.select("made").distinct().count() <= 8
    scored.unpersist()


def test_scoring_keeps_null_keys_and_arrays(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (None, [3.0])], "track_id bigint, audio array<double>")
    make = ops.row_by_row(lambda: lambda r: {"total": float(r["audio"].sum())})
    scored = ops.score_batches(df, make, "total double")
    assert sorted(map(repr, map(tuple, scored.collect()))) == [
        "(1, 3.0, None)",
        "(None, 3.0, None)",
    ]


def test_today_has_the_day_format():
    from tracklens.functions import today

    assert len(today()) == 8 and today().isdigit()


def test_a_scorer_may_return_whole_transcripts(spark):
    from tracklens import plans
    from tracklens.schemas import SEGMENT_TYPE

    def make_scorer():
        def transcribe(row):
            if len(row["audio"]) == 0:
                raise ValueError("no audio")
            # The probability may be missing, and times may be whole numbers.
            segments = [{"start": 0.0, "end": 2, "text": " La la"}]
            segments += [{"start": 2.0, "end": 3.5, "text": " x", "no_speech_prob": 0.6}]
            return {"text": " La la x", "segments": segments, "language": "en"}

        return transcribe

    df = spark.createDataFrame([(1, [0.1]), (2, [])], "track_id bigint, audio array<float>")
    schema = f"text string, segments array<{SEGMENT_TYPE.simpleString()}>"
    ok, errors = ops.split_errors(ops.score_batches(df, ops.row_by_row(make_scorer), schema))
    assert [tuple(r) for r in plans.track_metrics(ok).collect()] == [
        (1, 8, 2, 3.5, 2.0, 2.0 / 3.5, 1, 2, 1)
    ]
    assert [r["error"] for r in errors.collect()] == ["ValueError: no audio"]


def test_scoring_keeps_large_ids_beside_null(spark):
    seen = "array<struct<id:string,n:string>>"
    rows = [(9007199254740993, 9007199254740993), (None, None), (5, 7)]
    df = spark.createDataFrame(rows, "track_id bigint, n bigint").coalesce(1)
    scored = ops.score_batches(
        df, lambda: lambda rs: [{"got": [{"id": repr(r["track_id"]), "n": repr(r["n"])}]} for r in rs], f"got {seen}"
    )
    got = {r["track_id"]: tuple(r["got"][0]) for r in scored.collect()}
    assert got == {k: (repr(k), repr(n)) for k, n in rows}


def test_a_failing_batch_fails_only_its_bad_rows(spark):
    def make():
        def score(records):
            if any(r["x"] == 3 for r in records):
                raise RuntimeError("bad batch")
            return [{"y": "text" if r["x"] == 4 else r["x"]} for r in records]

        return score

    df = spark.range(0, 6, 1, 1).select(F.col("id").alias("track_id"), F.col("id").alias("x"))
    ok, errors = ops.split_errors(ops.score_batches(df, make, "y bigint"))
    assert {r["track_id"]: r["y"] for r in ok.collect()} == {0: 0, 1: 1, 2: 2, 5: 5}
    bad = {r["track_id"]: r["error"] for r in errors.collect()}
    assert bad[3] == "RuntimeError: bad batch" and bad[4].startswith("ArrowInvalid") and len(bad) == 2


def test_failed_rows_do_not_hold_their_batch(spark):
    import gc
    import weakref

    from tracklens.operators import scoring

    class Text:
        pass

    def make():
        def score(record):
            try:
                raise KeyError("inner")
            except KeyError as e:
                raise ValueError("no model") from e

        return score

    records = [{"text": Text()} for _ in range(4)]
    seen = [weakref.ref(r["text"]) for r in records]
    gc.disable()
    try:
        found = scoring._tried(ops.row_by_row(make)(), records)
        del records
        # Neither the errors nor a cycle of frames and lists keeps a record.
        assert [f"{e}" for e in found] == ["no model"] * 4 and isinstance(found[0].__cause__, KeyError)
        assert all(r() is None for r in seen)
    finally:
        gc.enable()


def test_batches_of_long_texts_are_scored_in_parts(spark):
    df = spark.range(0, 24, 1, 1).select(F.col("id").alias("track_id"), F.expr("repeat('x', 1000000 + id)").alias("text"))
    make = lambda: lambda records: [{"n": len(records), "size": len(r["text"])} for r in records]
    got = ops.score_batches(df, make, "n int, size long").collect()
    assert sorted((r.track_id, r["size"]) for r in got) == [(i, 1_000_000 + i) for i in range(24)]
    assert max(r.n for r in got) <= 5
