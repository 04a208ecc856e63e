"""Jobs that die at any point and are started again."""

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tracklens import plans, sources
from tracklens.plans import daily
from tracklens.session import scratch_dir
from tracklens.sources import files


class Died(Exception):
    pass


def dying(fn, at, after):
    """``fn``, which dies before or after its call number ``at``."""
    calls = [0]

    def run(*args, **kwargs):
        calls[0] += 1
        if calls[0] == at and not after:
            raise Died
        out = fn(*args, **kwargs)
        if calls[0] == at:
            raise Died
        return out

    return run


@pytest.mark.parametrize("partitioned", [False, True])
def test_a_switch_leaves_the_old_or_the_new_rows(spark, database, monkeypatch, partitioned):
    """Dies before and after every statement; the table is whole each time, and the next try ends well."""
    old, new = list(range(10)), list(range(5, 10))
    seen = set()
    for after in (False, True):
        for at in range(1, 20):
            table = f"{database}.t{at}_{int(after)}_{int(partitioned)}"
            made = spark.range(10).withColumn("day", F.lit("x")).write
            (made.partitionBy("day") if partitioned else made).saveAsTable(table)
            rows = spark.table(table).where("id >= 5")
            with monkeypatch.context() as patch:
                patch.setattr(SparkSession, "sql", dying(SparkSession.sql, at, after))
                try:
                    sources.replace_by_version(rows, table)
                    died = False
                except Died:
                    died = True
            if partitioned:
                sources.recover(spark, table)
            found = sorted(r["id"] for r in spark.table(table).collect())
            assert found in (old, new) and (died or found == new)
            seen.add(tuple(found))
            sources.replace_by_version(spark.table(table).where("id >= 5"), table)
            assert sorted(r["id"] for r in spark.table(table).collect()) == new
            if not died:
                break
    assert seen == {tuple(old), tuple(new)}


def test_a_failed_write_changes_nothing(spark, database):
    table = f"{database}.t"
    spark.range(10).write.saveAsTable(table)
    bad = spark.table(table).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        sources.replace_by_version(bad, table)
    assert spark.table(table).count() == 10
    with pytest.raises(ValueError):
        sources.replace_by_version(spark.range(3).toDF("other"), table)


def test_versions_are_cleaned_up_but_for_the_last_two(spark, database):
    table = f"{database}.t"
    sources.replace_by_version(spark.range(10), table)
    assert sources.version_tag(spark, table) is None
    first = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
    readers = []
    for k in range(4):
        readers.append(spark.table(table))
        sources.replace_by_version(spark.table(table).where(f"id > {k}"), table, f"day{k}")
        assert sources.version_tag(spark, table) == f"day{k}"
        # A query that began before the switch still has its rows.
        assert readers[-1].count() == 10 - k
    assert len(files.children(spark, f"{first}__versions")) == 2 and not files.exists(spark, first)
    spark.range(1).write.insertInto(table)
    assert spark.table(table).count() == 7


@pytest.fixture
def batch(spark, database):
    """A day's tables; ``batch(name)`` gives a new target, and a function that runs the day."""
    ids = range(1, 9)
    make = spark.createDataFrame
    make([(i, f"t{i}", 0.9, None) for i in ids], "track_id bigint, track_nm string, pop_score double, style_id_list array<int>").write.saveAsTable(f"{database}.track_all")
    make([(i + 100, i, "t", "a", "N", "N") for i in ids], "track_id bigint, b_track_id bigint, track_title string, track_artist_name_list string, lyric_yn string, sync_lyric_yn string").write.saveAsTable(f"{database}.mcp_track")
    make([(101, "x", "VOCAL")], "track_id bigint, artist_text string, artist_role_type string").write.saveAsTable(f"{database}.mcp_artist")
    make([(1, 1)], "track_id bigint, svc_genre_id bigint").write.saveAsTable(f"{database}.genre_map")
    make([(1, "pop")], "svc_genre_id bigint, svc_genre_nm string").write.saveAsTable(f"{database}.genre")
    segments = "array(named_struct('start', 0D, 'end', 2D, 'text', 'a b', 'no_speech_prob', 0.1D))"

    def new(name):
        same = {n: f"{database}.{n}" for n in ("track_all", "mcp_track", "mcp_artist", "genre_map", "genre")}
        own = {n: f"{database}.{n}_{name}" for n in ("daily", "target", "staging", "statistics")}
        tables = plans.DailyTables(**same, **own)
        sources.ensure_metrics_table(spark, f"{tables.target}_empty")
        known = spark.table(f"{tables.target}_empty")
        row = spark.range(1).select(*(F.lit({"track_id": 3, "yyyymmdd": "20230101"}.get(f.name, 1)).cast(f.dataType).alias(f.name) for f in known.schema))
        row.unionByName(row.withColumn("track_id", F.lit(50).cast("long"))).write.saveAsTable(tables.target)
        root, asked = scratch_dir(spark, "days"), []

        def transcribe(listed):
            asked.append(1)
            return listed.select(
                "track_id", F.lit("a b").alias("text"), F.expr(segments).alias("segments"),
                F.when(F.col("track_id") == 5, "no audio").alias("error"),
            )

        def run():
            counts = {r["stage"]: r["n"] for r in plans.run_daily(spark, tables, root, transcribe, "20240101").collect()}
            rows = [sorted(map(repr, map(tuple, spark.table(t).select(sorted(spark.table(t).columns)).collect()))) for t in (tables.target, tables.statistics)]
            return counts, rows, len(asked)

        return run

    return new


def test_a_broken_day_ends_like_a_clean_one(spark, batch, monkeypatch):
    clean = batch("clean")
    want = clean()
    assert want[0]["source"] == 8 and want[0]["after_dedupe"] == 8 and len(want[1][0]) == 8
    assert clean() == want
    finish = plans.Ledger.finish

    def dying_at(step, after):
        def run(self, name, counts=None):
            if name == step and not after:
                raise Died
            finish(self, name, counts)
            if name == step:
                raise Died

        return plans.Ledger, "finish", run

    points = {
        "listed": dying_at("create", False),
        "chosen": dying_at("create", True),
        "transcribed": dying_at("detect", True),
        "uploaded": dying_at("upload", False),
        "written": dying_at("refreshed", True),
        "unswitched": (daily, "switch_version", dying(daily.switch_version, 1, False)),
        "switched": (daily, "switch_version", dying(daily.switch_version, 1, True)),
        "refreshed": dying_at("refresh", False),
        "published": dying_at("publish", False),
    }
    for name, (owner, attribute, dies) in points.items():
        run = batch(name)
        with monkeypatch.context() as patch:
            patch.setattr(owner, attribute, dies)
            with pytest.raises(Died):
                run()
        assert run() == want, name
