"""Heavy keys: same rows as a plain join, and really spread."""

import pytest
from pyspark.sql import functions as F

from tracklens.operators import expand_counts, heavy_keys, keyed_join, use_all_cores


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def facts(spark):
    """3000 rows: a third has key 7, a third has none, the rest is spread."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id"))
    # Exact copies too, so spreading cannot rely on the rows' values.
    return spark.range(0, 3000, 1, 8).select(
        key.cast("bigint").alias("k"), (F.col("id") % 2).alias("v")
    )


def lookup(spark):
    return spark.range(0, 1000).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("w"))


def bag(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_many_on_the_left(spark, no_broadcast, how):
    left, right = facts(spark), lookup(spark)
    plain = left.join(right, left.k == right.rk, how).drop("rk")
    salted = keyed_join(left, right, "k", "rk", how, many="left", rows_per_task=150)
    assert bag(salted) == bag(plain)
    assert "xxhash64" in salted._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_many_on_the_right(spark, no_broadcast, how):
    # 7 is heavy on the right; 5000 is unmatched; NULL never matches.
    left = spark.createDataFrame([(7, "a"), (1, "b"), (5000, "c"), (None, "d")], "k bigint, n string")
    right = facts(spark).withColumnRenamed("k", "rk")
    plain = left.join(right, left.k == right.rk, how).drop("rk")
    salted = keyed_join(left, right, "k", "rk", how, many="right", rows_per_task=150)
    assert bag(salted) == bag(plain)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_heavy_keys_on_both_sides(spark, no_broadcast, how):
    # 7 is heavy on both sides, 3 on the right only, NULL on the left only.
    left = facts(spark)
    right = facts(spark).limit(0).union(
        spark.range(0, 400).select(
            F.when(F.col("id") % 2 == 0, 3).when(F.col("id") % 4 == 1, 7).otherwise(F.col("id")), "id"
        )
    ).toDF("rk", "w")
    plain = left.join(right, left.k == right.rk, how).drop("rk")
    salted = keyed_join(left, right, "k", "rk", how, many="both", rows_per_task=60)
    assert bag(salted) == bag(plain)
    known = keyed_join(left, right, "k", "rk", how, "both", left_heavy={7: 1000}, rows_per_task=60)
    assert bag(known) == bag(plain)


def test_more_salts_than_heavy_rows(spark, no_broadcast):
    left = spark.createDataFrame([(7, "a"), (8, "b")], "k bigint, n string")
    right = spark.createDataFrame([(7, 1), (7, 2)], "rk bigint, v int")
    salted = keyed_join(left, right, "k", "rk", "left", many="right", rows_per_task=1)
    assert bag(salted) == bag(left.join(right, left.k == right.rk, "left").drop("rk"))


def test_heavy_rows_reach_many_sub_keys(spark, no_broadcast):
    from tracklens.operators.skew import _salted, _sub_keys

    spread = _salted(facts(spark), "k", _sub_keys(F.col("k"), {7: 8, None: 8}), F.lit(1), "s")
    for hot in (F.col("k") == 7, F.col("k").isNull()):
        assert spread.filter(hot).select("s").distinct().count() > 4
    assert spread.filter("k <> 7").select("s").distinct().count() == 1


def test_heavy_keys_finds_null_and_hot(spark):
    assert heavy_keys(facts(spark), "k", min_rows=100) == {
        7: pytest.approx(1000, rel=0.05), None: pytest.approx(1000, rel=0.05)
    }
    assert heavy_keys(facts(spark), "k") == {}
    assert heavy_keys(facts(spark).limit(0), "k", min_rows=0) == {}


def test_a_hot_key_is_found_however_well_its_column_compresses(spark, tmp_path):
    # Half of the rows have one key: the file is tiny, the estimate of its size too.
    hot = F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 1000)
    spark.range(0, 2_000_000, 1, 4).select(hot.alias("k")).write.parquet(str(tmp_path / "hot"))
    found = heavy_keys(spark.read.parquet(str(tmp_path / "hot")), "k", min_rows=100_000)
    assert list(found) == [7] and found[7] >= 1_000_000


def test_salts_follow_the_rows_of_a_key(spark):
    from tracklens.operators.skew import _sub_keys

    keys = spark.createDataFrame([(7,), (8,), (None,)], "k bigint")
    got = keys.select(_sub_keys(F.col("k"), {7: 50, None: 3}).alias("n")).collect()
    assert [r["n"] for r in got] == [50, 1, 3]


def test_unique_sides_are_not_searched(spark, no_broadcast, monkeypatch):
    from tracklens.operators import skew

    monkeypatch.setattr(skew, "heavy_rows", lambda *_: pytest.fail("searched"))
    joined = keyed_join(lookup(spark), lookup(spark).toDF("k", "x"), "rk", "k", many="none")
    assert joined.count() == 1000
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def test_size_settings_in_every_spelling():
    from tracklens.operators.skew import _bytes

    assert [_bytes(x) for x in ("10485760b", "10MB", "10m", "256k", "-1", "7")] == [
        10485760, 10485760, 10485760, 262144, -1, 7,
    ]


def test_small_side_is_left_to_broadcast(spark):
    joined = keyed_join(facts(spark), lookup(spark), "k", "rk", "left", rows_per_task=1)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "xxhash64" not in plan


def test_join_arguments(spark):
    with pytest.raises(ValueError):
        keyed_join(facts(spark), lookup(spark), "k", "rk", "full")
    with pytest.raises(ValueError):
        keyed_join(facts(spark), lookup(spark), "k", "rk", "left_anti", many="right")


def test_expand_counts(spark):
    rows = [(1, 1), (2, 0), (3, 25), (4, 10), (5, 1)]
    df = spark.createDataFrame(rows, "track_id bigint, n bigint")
    got = expand_counts(df, "n", chunk=10).groupBy("track_id").count().collect()
    assert {r["track_id"]: r["count"] for r in got} == {1: 1, 3: 25, 4: 10, 5: 1}
    plan = expand_counts(df, "n", chunk=10)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan and plan.count("Exchange") == 1


def test_use_all_cores(spark):
    one = spark.range(0, 1_000_000, 1, 1)
    assert use_all_cores(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert use_all_cores(one, bytes_per_core=1).rdd.getNumPartitions() == 1
    assert use_all_cores(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == 1


def test_a_task_is_given_few_shuffled_bytes(spark):
    from tracklens.operators.skew import _bytes
    from tracklens.session import MOST_ADVISORY

    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    try:
        for given, kept in (("64MB", MOST_ADVISORY), ("1m", 1024**2)):
            spark.conf.set(name, given)
            keyed_join(facts(spark), lookup(spark), "k", "rk")
            assert _bytes(spark.conf.get(name)) == kept
    finally:
        spark.conf.set(name, before)
