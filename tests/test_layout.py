"""Tables in buckets by track id: no row moves for a join or grouping by it."""

import pytest
from pyspark.sql import functions as F

from tests.test_plans import bag, catalog, plan_of
from tracklens import plans, sources

BY = {"track_all": "track_id", "mcp_track": "b_track_id", "done": "track_id", "target": "track_id", "genre_map": "track_id"}


@pytest.fixture
def laid_out(spark, database):
    """(tables in buckets, the same tables as they were); broadcasts of the genre list alone."""
    t = catalog(spark, seed=12)
    out = dict(t)
    for name, key in BY.items():
        sources.write_bucketed(t[name], f"{database}.{name}", 6, key)
        out[name] = spark.table(f"{database}.{name}")
        assert sources.buckets_of(spark, f"{database}.{name}") == (6, [key])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200")
    yield out, t, database
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def moved(df):
    """What the rows are dealt out by."""
    return [line for line in plan_of(df).splitlines() if "hashpartitioning" in line]


def test_jobs_on_one_layout_move_nothing_by_track(spark, laid_out):
    t, plain, _ = laid_out
    refreshed = plans.refresh_target(t["target"], t["track_all"], t["mcp_track"], [7], "b_track_id", in_place=True)
    assert moved(refreshed) == []
    assert bag(refreshed) == bag(plans.refresh_target(plain["target"], plain["track_all"], plain["mcp_track"], [7], "b_track_id"))
    chosen = plans.create_candidates(t["track_all"], t["mcp_track"], t["done"], style_ids=[7])
    counts = plans.candidate_counts(t["track_all"], t["mcp_track"], t["done"], style_ids=[7])
    assert moved(counts) == []
    assert bag(chosen) == bag(plans.create_candidates(plain["track_all"], plain["mcp_track"], plain["done"], style_ids=[7]))


def test_statistics_move_rows_by_artist_alone(spark, laid_out):
    t, plain, database = laid_out
    kept = plans.refresh_target(plain["target"], plain["track_all"], plain["mcp_track"], [7], "b_track_id")
    sources.replace_by_version(kept, f"{database}.target")
    assert sources.buckets_of(spark, f"{database}.target") == (6, ["track_id"])
    genre = spark.createDataFrame(plain["genre"].collect(), plain["genre"].schema)
    target = spark.table(f"{database}.target")
    known = {"mcp_track": sources.known_heavy_keys(spark, f"{database}.mcp_track", "b_track_id")}
    assert known == {"mcp_track": {}}
    got = plans.track_statistics(target, t["mcp_track"], plain["artists"], t["genre_map"], F.broadcast(genre), heavy=known)
    by = moved(got)
    assert by and not any("hashpartitioning(track_id#" in x and "artist" not in x for x in by if "b_track_id" in x)
    assert bag(got) == bag(plans.track_statistics(kept, plain["mcp_track"], plain["artists"], plain["genre_map"], plain["genre"]))


def test_a_day_behind_a_bucketed_target(spark, laid_out):
    t, plain, database = laid_out
    day = plain["target"].limit(40).withColumn("yyyymmdd", F.lit("20240103"))
    both = plans.with_source(t["target"], day)
    want = plain["target"].union(day)
    assert bag(both) == bag(want)
    got = plans.refresh_target(both, t["track_all"], t["mcp_track"], [7], "b_track_id")
    again = plans.refresh_target(want, plain["track_all"], plain["mcp_track"], [7], "b_track_id")
    assert bag(got) == bag(again)
    sources.replace_by_version(got, f"{database}.target")
    assert bag(spark.table(f"{database}.target")) == bag(again)
    assert sources.buckets_of(spark, f"{database}.target") == (6, ["track_id"])
    assert not spark.catalog.tableExists(f"{database}.target__writing")
