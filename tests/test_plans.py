import contextlib
import io
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tracklens import operators as ops
from tracklens import plans, sources
from tracklens.operators import skew
from tracklens.session import scratch_dir


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def bag(df):
    return sorted(map(repr, map(tuple, df.select(sorted(df.columns)).collect())))


def catalog(spark, seed=3, n=300):
    """Small tables with repeated ids, NULL keys and one heavy key (id 1)."""
    rng = random.Random(seed)

    def key():
        return rng.choice([1, 1, None] + list(range(2, 40)) * 2)

    styles = [None, [], [5], [7], [7, None], [5, None], [5, 6]]
    track_all = [(key(), f"t{i}", rng.choice([0.1, 0.2, 0.9, None]), rng.choice(styles)) for i in range(n)]
    mcp = [
        (i + 100, key(), f"title{i}", f"artist{i}", rng.choice(["N", "N", "Y", None]), rng.choice(["N", "Y"]))
        for i in range(n)
    ]
    done = [(rng.choice([None, 2, 3, 5, 8, 8, 13]),) for _ in range(30)]
    target = [
        (key(), rng.randrange(40), rng.randrange(30), rng.choice(["20240101", "20240102", None]))
        for _ in range(n)
    ]
    artists = [
        (rng.choice([None] + list(range(100, 100 + n))), rng.choice(["a", "b", None]), rng.choice(["VOCAL", "X"]))
        for _ in range(n)
    ]
    pairs = [(key(), rng.choice([19, 119, 3, 4, None])) for _ in range(n)]
    genre = [(19, "OST"), (119, "Indie"), (3, None)]
    make = spark.createDataFrame
    return {
        "track_all": make(track_all, "track_id bigint, track_nm string, pop_score double, style_id_list array<int>"),
        "mcp_track": make(mcp, "track_id bigint, b_track_id bigint, track_title string, track_artist_name_list string, lyric_yn string, sync_lyric_yn string"),
        "done": make(done, "track_id bigint"),
        "target": make(target, "track_id bigint, nsp06_word_cnt int, nsp06_unique_word_cnt int, yyyymmdd string"),
        "artists": make(artists, "track_id bigint, artist_text string, artist_role_type string"),
        "genre_map": make(pairs, "track_id bigint, svc_genre_id bigint"),
        "genre": make(genre, "svc_genre_id bigint, svc_genre_nm string"),
    }


def in_files(spark, tables):
    """The same tables in Parquet files, whose size Spark can tell."""
    out = {}
    for name, df in tables.items():
        path = scratch_dir(spark, name)
        df.write.parquet(path)
        out[name] = spark.read.parquet(path)
    return out


def plain(df):
    return [r.asDict() for r in df.collect()]


def test_candidates_from_sets_of_ids(spark, no_broadcast):
    t = catalog(spark)
    got = plans.create_candidates(t["track_all"], t["mcp_track"], t["done"], style_ids=[7])
    wanted, silent = Counter(), Counter()
    for r in plain(t["track_all"]):
        styles = r["style_id_list"]
        # Unknown styles beside no hit leave it open whether the track is excluded.
        fine = styles is None or not (7 in styles or (None in styles))
        if r["track_id"] is not None and (r["pop_score"] or 0) >= 0.2 and fine:
            wanted[r["track_id"]] += 1
    for r in plain(t["mcp_track"]):
        if r["lyric_yn"] == r["sync_lyric_yn"] == "N":
            silent[r["b_track_id"]] += 1
    done = {r["track_id"] for r in plain(t["done"])}
    expected = Counter({k: n * silent[k] for k, n in wanted.items() if k not in done and silent[k]})
    assert Counter(r["track_id"] for r in plain(got)) == expected
    assert sum(expected.values()) > 100 and max(expected.values()) > 9


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("key", ["track_id", "b_track_id"])
def test_refresh_counts_and_rows(spark, key, small):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before if small else "-1")
    t = in_files(spark, catalog(spark, seed=5))
    target = plain(t["target"])
    excluded = {r["track_id"] for r in plain(t["track_all"]) if 7 in (r["style_id_list"] or [])}
    entries = Counter(r[key] for r in plain(t["mcp_track"]))
    silent = Counter(r[key] for r in plain(t["mcp_track"]) if r["lyric_yn"] != "Y")
    # NULL is never equal to NULL, so rows without an id are neither excluded nor matched.
    styled = [r for r in target if r["track_id"] is None or r["track_id"] not in excluded]
    times = [
        1 if r["track_id"] is None or not entries[r["track_id"]] else silent[r["track_id"]]
        for r in styled
    ]
    kept = {r["track_id"] for r, n in zip(styled, times, strict=True) if n} - {None}
    audit = plans.Audit()
    got = plans.refresh_target(t["target"], t["track_all"], t["mcp_track"], [7], key, audit=audit)
    assert got.columns == t["target"].columns
    rows = got.collect()
    assert sorted(r["track_id"] for r in rows) == sorted(kept)
    newest = {r["track_id"]: r for r in ops.dedupe_tracks(t["target"]).collect()}
    assert all(newest[r["track_id"]] == r for r in rows)
    expected = {
        "excluded": len(excluded),
        "source": len(target),
        "after_style": len(styled),
        "after_lyric": sum(times),
        "after_dedupe": len(kept),
    }
    assert audit.counts() == expected
    counted = plans.audit_counts(t["target"], t["track_all"], t["mcp_track"], [7], key)
    assert {r["stage"]: r["n"] for r in counted.collect()} == expected
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        df.explain("formatted")
    return said.getvalue()


@pytest.mark.parametrize("large", [False, True])
def test_refresh_neither_sorts_nor_gathers_whole_rows(spark, large, request):
    if large:
        request.getfixturevalue("no_broadcast")
    t = in_files(spark, catalog(spark, seed=5))
    for got in (
        plans.refresh_target(t["target"], t["track_all"], t["mcp_track"], [7]),
        ops.dedupe_tracks(t["target"]),
    ):
        tree = plan_of(got)
        assert "SortAggregate" not in tree and "ShuffledHashJoin" in tree
        # The one sort of whole rows is behind the join, over rows of equal order alone.
        for n in re.findall(r"\((\d+)\) Sort ?\n", tree):
            rows = re.search(rf"\({n}\) Sort ?\nInput \[\d+\]: \[(.*?)\]", tree)[1]
            assert "yyyymmdd" not in rows or "nsp06_word_cnt" in rows and tree.count("Window") > 0


def test_refresh_of_empty_tables(spark):
    t = {name: df.limit(0) for name, df in catalog(spark).items()}
    audit = plans.Audit()
    got = plans.refresh_target(t["target"], t["track_all"], t["mcp_track"], [7], audit=audit)
    assert got.collect() == [] and set(audit.counts().values()) == {0}
    # An empty target alone must not hide how many tracks are excluded.
    tracks = catalog(spark)["track_all"]
    audit = plans.Audit()
    plans.refresh_target(t["target"], tracks, t["mcp_track"], [7], audit=audit)
    assert audit["excluded"] == ops.excluded_track_ids(tracks, [7]).count() > 0
    counted = plans.audit_counts(t["target"], t["track_all"], t["mcp_track"], [7])
    assert {r["n"] for r in counted.collect()} == {0}
    with pytest.raises(KeyError):
        audit["uploaded"]


def test_counts_do_not_change_with_tasks_that_run_twice(spark, tmp_path):
    """A task of the pass over the keys fails once, after it has read its rows."""
    t = in_files(spark, catalog(spark, seed=5))
    mark = tmp_path / "failed"

    def flaky(batches):
        for batch in batches:
            yield batch
            if batch.num_rows and not mark.exists():
                mark.touch()
                raise RuntimeError("lost")

    target = t["target"].mapInArrow(flaky, t["target"].schema)
    clean, retried = plans.Audit(), plans.Audit()
    want = plans.refresh_target(t["target"], t["track_all"], t["mcp_track"], [7], audit=clean)
    jobs = spark.sparkContext
    if jobs.master.startswith("local["):
        # A local session gives up at the first failure; the job is started again as a whole.
        with pytest.raises(Exception, match="lost"):
            plans.refresh_target(target, t["track_all"], t["mcp_track"], [7], audit=retried)
    got = plans.refresh_target(target, t["track_all"], t["mcp_track"], [7], audit=retried)
    assert mark.exists() and retried.counts() == clean.counts()
    assert bag(got) == bag(want)


def listed(names):
    return ",".join(sorted(n for n in names if n is not None))


@pytest.mark.parametrize("salted", [False, True])
def test_statistics_and_report(spark, no_broadcast, monkeypatch, salted):
    import tracklens.plans.reports as reports

    searched = []
    search = skew.heavy_rows

    def counting(df, key, *_):
        searched.append(key)
        # Let a handful of rows count as heavy.
        return search(df, key, 6) if salted else search(df, key)

    monkeypatch.setattr(skew, "heavy_rows", counting)
    monkeypatch.setattr(reports, "heavy_rows", counting)
    if salted:
        monkeypatch.setattr(skew.keyed_join, "__defaults__", (None, "inner", "left", None, 6, None))
    t = catalog(spark, seed=9)
    one_each = ops.dedupe_tracks(ops.require_key(t["target"])).drop("yyyymmdd")
    got = plans.track_statistics(
        one_each, t["mcp_track"], t["artists"], t["genre_map"], t["genre"]
    )
    assert len(got.columns) == 12
    assert searched.count(skew._RIGHT_KEY) <= 2
    names = {r["svc_genre_id"]: r["svc_genre_nm"] for r in plain(t["genre"])}
    genres, singers, entries = defaultdict(list), defaultdict(list), defaultdict(list)
    for r in plain(t["genre_map"]):
        if r["svc_genre_id"] in names:
            genres[r["track_id"]].append(r["svc_genre_id"])
    for r in plain(t["artists"]):
        if r["artist_role_type"] == "VOCAL":
            singers[r["track_id"]].append(r["artist_text"])
    for r in plain(t["mcp_track"]):
        entries[r["b_track_id"]].append(r)
    expected = []
    for r in plain(one_each):
        k = r["track_id"]
        for m in entries[k] or [defaultdict(lambda: None)]:
            by = listed(singers[m["track_id"]]) if m["track_id"] in singers else None
            of = listed(names[g] for g in genres[k]) if k in genres else None
            expected.append((k, m["track_title"], by, of, m["lyric_yn"]))
    assert Counter(tuple(r)[:5] for r in got.collect()) == Counter(expected)

    report = plain(plans.candidate_report(t["track_all"], t["mcp_track"], t["genre_map"], t["genre"]))
    pops = [r["pop_score"] for r in report]
    assert pops and pops == sorted(pops, reverse=True)
    wanted = Counter()
    for r in plain(t["track_all"]):
        k = r["track_id"]
        if k is not None and (r["pop_score"] or 0) >= 0.2 and {19, 119} & set(genres[k]):
            for m in entries[k]:
                if m["lyric_yn"] == m["sync_lyric_yn"] == "N":
                    wanted[r["track_nm"], m["track_artist_name_list"]] += 1
    assert Counter((r["track_nm"], r["track_artist_name_list"]) for r in report) == wanted
    exact = plans.candidate_report(
        t["track_all"], t["mcp_track"], t["genre_map"], t["genre"], genre_ids=[3], whole_ids=True
    )
    sub = plans.candidate_report(
        t["track_all"], t["mcp_track"], t["genre_map"], t["genre"], genre_ids=[3]
    )
    assert bag(exact) == bag(sub)


def test_log_summary_over_files(spark, tmp_path):
    (tmp_path / "a.log").write_text("Voice detected: {'track_id': 1}\nnoise\n")
    (tmp_path / "b.log").write_text("Voice detected: {'track_id': 1}\nVoice is not detected: {'track_id': 2}\n")
    got = plans.log_verdict_summary(spark, str(tmp_path / "*.log"))
    assert {r["verdict"]: r["n"] for r in got.collect()} == {True: 2, False: 1}


def test_failed_upload_raises(spark, database):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        plans.upload_metrics(spark, "/no/such/file.csv", f"{database}.daily", "20240101")


def test_two_days_in_a_row(spark, database):
    t = catalog(spark, seed=21)
    for name in ("track_all", "mcp_track", "artists", "genre_map", "genre"):
        t[name].write.saveAsTable(f"{database}.{name}")
    sources.ensure_metrics_table(spark, f"{database}.empty")
    target = f"{database}.target"
    ops.normalize_key(spark.table(f"{database}.empty")).write.saveAsTable(target)
    tables = plans.DailyTables(
        track_all=f"{database}.track_all",
        mcp_track=f"{database}.mcp_track",
        mcp_artist=f"{database}.artists",
        genre_map=f"{database}.genre_map",
        genre=f"{database}.genre",
        daily=f"{database}.daily",
        target=target,
        staging=f"{database}.staging",
        statistics=f"{database}.statistics",
        style_ids=[7],
    )
    seg = "array(named_struct('start', 0D, 'end', 2D, 'text', 'a b', 'no_speech_prob', 0.1D))"

    def transcribe(ids):
        failed = F.col("track_id") % 5 == 0
        return ids.select(
            "track_id",
            F.lit("a b").alias("text"),
            F.expr(seg).alias("segments"),
            F.when(failed, "no audio").alias("error"),
        )

    root = scratch_dir(spark, "days")
    first = {r["stage"]: r["n"] for r in plans.run_daily(spark, tables, root, transcribe, "20240101").collect()}
    assert first["selected"] == first["transcribed"] + first["failed"] + first["missing"]
    assert first["failed"] > 0 and first["missing"] == first["rejected"] == first["bad_key"] == 0
    assert first["uploaded"] == first["transcribed"] == first["source"]
    assert first["after_dedupe"] == spark.table(target).count()
    stats = spark.table(tables.statistics)
    assert {r["track_id"] for r in stats.collect()} == {r["track_id"] for r in spark.table(target).collect()}
    assert {r["nsp06_word_cnt"] for r in stats.collect()} == {2}
    errors = spark.read.csv(f"{root}/20240101/errors", header=True)
    assert errors.count() == first["failed"]
    # The next day picks only what failed, or was taken out by the refresh.
    before = {r["track_id"] for r in spark.table(target).collect()}
    plans.run_daily(spark, tables, root, transcribe, "20240102")
    again, _ = sources.read_work_list(spark, f"{root}/20240102/work_list")
    assert before.isdisjoint(r["track_id"] for r in again.collect())
    assert {r["track_id"] for r in spark.table(target).collect()} == before
    # A day with nothing to choose still refreshes and publishes.
    tables.threshold = 2.0
    idle = {r["stage"]: r["n"] for r in plans.run_daily(spark, tables, root, transcribe, "20240103").collect()}
    assert idle["selected"] == 0 and "uploaded" not in idle
    assert idle["after_dedupe"] == len(before)


@pytest.fixture
def one_day(spark, database):
    """A day with large ids; call it with a transcriber, get the counts and the folder."""
    rows = [(3_000_000_000 + i, f"t{i}", 0.9, None) for i in range(6)]
    entries = [(i, 3_000_000_000 + i, "t", "a", "N", "N") for i in range(6)]
    make = spark.createDataFrame
    make(rows, "track_id bigint, track_nm string, pop_score double, style_id_list array<int>").write.saveAsTable(f"{database}.track_all")
    make(entries, "track_id bigint, b_track_id bigint, track_title string, track_artist_name_list string, lyric_yn string, sync_lyric_yn string").write.saveAsTable(f"{database}.mcp_track")
    make([], "track_id bigint, artist_text string, artist_role_type string").write.saveAsTable(f"{database}.artists")
    make([], "track_id bigint, svc_genre_id bigint").write.saveAsTable(f"{database}.genre_map")
    make([], "svc_genre_id bigint, svc_genre_nm string").write.saveAsTable(f"{database}.genre")
    sources.ensure_metrics_table(spark, f"{database}.target")
    tables = plans.DailyTables(
        **{n: f"{database}.{n}" for n in ("track_all", "mcp_track", "genre_map", "genre", "daily", "target", "staging", "statistics")},
        mcp_artist=f"{database}.artists",
    )
    root = scratch_dir(spark, "days")

    def run(transcribe, day):
        counts = {r["stage"]: r["n"] for r in plans.run_daily(spark, tables, root, transcribe, day).collect()}
        return counts, f"{root}/{day}", spark.table(tables.target)

    return run


def scored(ids, keep):
    return ids.filter(keep).select(
        "track_id", F.lit("a b").alias("text"),
        F.expr("array(named_struct('start', 0D, 'end', 2D, 'text', 'a b', 'no_speech_prob', 0.1D))").alias("segments"),
        F.lit(None).cast("string").alias("error"),
    )


def test_a_transcriber_that_returns_nothing_is_noticed(spark, one_day):
    counts, folder, _ = one_day(lambda ids: scored(ids, F.lit(False)), "20240101")
    assert counts["selected"] == counts["missing"] == 6 and counts["transcribed"] == 0
    errors = spark.read.csv(f"{folder}/errors", header=True).collect()
    assert {r["error"] for r in errors} == {"not returned"} and len(errors) == 6


def test_large_ids_reach_the_target_and_are_not_chosen_again(spark, one_day):
    counts, _, target = one_day(lambda ids: scored(ids, F.col("track_id") % 2 == 0), "20240101")
    assert counts["uploaded"] == counts["after_dedupe"] == 3 and counts["missing"] == 3
    assert {r["track_id"] for r in target.collect()} == {3_000_000_000, 3_000_000_002, 3_000_000_004}
    again, _, _ = one_day(lambda ids: scored(ids, F.lit(True)), "20240102")
    assert again["selected"] == 3


@pytest.mark.parametrize("mode,bad", [("fixed", ["x"]), ("faithful", ["3000000000", "x"])])
def test_rows_with_a_bad_key_are_set_aside(spark, database, tmp_path, mode, bad):
    head = "track_id,text_length,total_duration"
    (tmp_path / "m.csv").write_text(f"{head}\n1,2,3.5\nx,4,5.5\n3000000000,6,7.5\n")
    audit = plans.Audit()
    table, aside = f"{database}.daily_{mode}", str(tmp_path / "bad")
    plans.upload_metrics(spark, str(tmp_path / "m.csv"), table, "20240101", mode, audit=audit, bad_keys=aside)
    assert audit.counts() == {"bad_key": len(bad), "uploaded": 3 - len(bad)}
    assert sorted(r["track_id"] for r in spark.read.csv(aside, header=True).collect()) == bad
    assert spark.table(table).filter("track_id IS NULL").count() == 0
