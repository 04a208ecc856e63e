"""Heavy keys: noted with the table, read and planned without a job."""

import pytest
from pyspark.sql import functions as F

from tests.test_plans import bag, catalog
from tests.test_skew import facts, lookup, no_broadcast  # noqa: F401
from tracklens import operators as ops
from tracklens import plans, sources
from tracklens.sources.frequent import note_heavy_keys


def jobs_of(spark, work):
    """What ``work`` returns, and the jobs it started."""
    group = f"jobs-of-{id(work)}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_the_counter_of_jobs_counts(spark):
    assert jobs_of(spark, lambda: spark.range(10).agg(F.max("id")).collect())[1] > 0


def test_planning_starts_no_job(spark, database, no_broadcast):  # noqa: F811
    t = catalog(spark, seed=21)
    for name in ("track_all", "mcp_track", "genre_map", "genre", "artists", "target"):
        t[name].write.saveAsTable(f"{database}.{name}")
        t[name] = spark.table(f"{database}.{name}")
    one_each = ops.dedupe_tracks(ops.require_key(t["target"])).drop("yyyymmdd")
    report, jobs = jobs_of(spark, lambda: plans.candidate_report(t["track_all"], t["mcp_track"], t["genre_map"], t["genre"]))
    assert jobs == 0
    statistics, jobs = jobs_of(
        spark, lambda: plans.track_statistics(one_each, t["mcp_track"], t["artists"], t["genre_map"], t["genre"])
    )
    assert jobs == 0
    known = {"track_all": {1: 150, None: 40}, "mcp_track": {1: 100}, "genre_map": {}}
    again = plans.candidate_report(t["track_all"], t["mcp_track"], t["genre_map"], t["genre"], heavy=known)
    assert bag(report) == bag(again)
    more = plans.track_statistics(one_each, t["mcp_track"], t["artists"], t["genre_map"], t["genre"], heavy=known)
    assert bag(statistics) == bag(more)


def test_keys_are_noted_combined_and_read_without_a_job(spark, database):
    name = f"{database}.noted"
    facts(spark).write.saveAsTable(name)
    assert sources.known_heavy_keys(spark, name, "k") is None
    note_heavy_keys(spark.table(name), name, "k", min_rows=900)
    known, jobs = jobs_of(spark, lambda: sources.known_heavy_keys(spark, name, "k"))
    assert jobs == 0
    assert known == {7: pytest.approx(1000, rel=0.05), None: pytest.approx(1000, rel=0.05)}
    more = spark.range(0, 950).select(F.lit(8).cast("bigint").alias("k"), F.lit(0).cast("bigint").alias("v"))
    more.write.insertInto(name)
    note_heavy_keys(more, name, "k", added=True, min_rows=900)
    assert set(sources.known_heavy_keys(spark, name, "k")) == {7, None, 8}
    note_heavy_keys(more, name, "k", min_rows=900)
    assert set(sources.known_heavy_keys(spark, name, "k")) == {8}
    note_heavy_keys(more.limit(0), name, "k")
    assert sources.known_heavy_keys(spark, name, "k") == {}


def test_names_as_keys(spark, database):
    name = f"{database}.named"
    rows = [("it's",)] * 5 + [('a "b" \\\\ c',)] * 4 + [("é",)]
    spark.createDataFrame(rows, "k string").write.saveAsTable(name)
    note_heavy_keys(spark.table(name), name, "k", min_rows=4)
    assert sources.known_heavy_keys(spark, name, "k") == {"it's": 5, rows[5][0]: 4}


def test_noted_keys_stay_through_a_version_switch(spark, database):
    name = f"{database}.switched"
    sources.write_bucketed(facts(spark), name, 4, "k")
    note_heavy_keys(spark.table(name), name, "k", min_rows=900)
    before = sources.known_heavy_keys(spark, name, "k")
    sources.replace_by_version(spark.table(name).where("k = 7"), name)
    assert sources.known_heavy_keys(spark, name, "k") == before
    note_heavy_keys(spark.table(name), name, "k", min_rows=900)
    assert set(sources.known_heavy_keys(spark, name, "k")) == {7}


@pytest.mark.parametrize("kind", ["int", "string", "double"])
def test_keys_of_other_types(spark, no_broadcast, kind):  # noqa: F811
    right = lookup(spark).withColumn("rk", F.col("rk").cast(kind))
    left = facts(spark)
    joined = ops.keyed_join(left, right, "k", "rk", "left", many="both", rows_per_task=100)
    assert bag(joined) == bag(left.join(right, left.k == right.rk, "left").drop("rk"))


def test_buckets_by_a_day_are_written_and_not_noted(spark, database):
    name = f"{database}.days"
    days = spark.range(0, 20).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("d"))
    sources.write_bucketed(days, name, 2, "d")
    assert spark.table(name).count() == 20
    assert sources.known_heavy_keys(spark, name, "d") is None
