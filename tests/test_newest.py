import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklens import operators as ops
from tracklens.operators import newest

DAYS = ["20240101", "2024-01-01", "2024-01-02", "2024/01/02", "20240101 ", "", "-", ",", "0", "9", ":", "a", "2024-01-01x",
        "2024-01-011", "2024-01-01é", "é", "20240a", "20240,", "20240-", "99999999999", "9999999999", None]
COUNTS = [None, -(2**63), -5, -2, -1, 0, 1, 7, 2**23 - 5, 2**23 - 4, 2**23, 2**40, 2**63 - 1]


def before(a, b):
    """Whether a comes before b: NULL first, texts by their bytes."""
    for x, y in zip(a, b, strict=True):
        x, y = ((v is not None, v.encode() if isinstance(v, str) else v) for v in (x, y))
        if x != y:
            return x[0] < y[0] if x[0] != y[0] else x[1] < y[1]
    return False


def test_numbers_never_fall_where_the_order_rises(spark):
    rows = [(d, n) for d in DAYS for n in COUNTS]
    df = spark.createDataFrame(rows, "yyyymmdd string, nsp06_word_cnt long")
    for order in (["yyyymmdd", "nsp06_word_cnt"], ["nsp06_word_cnt", "yyyymmdd"], ["yyyymmdd"]):
        got = [(tuple(r[c] for c in order), r["x"]) for r in df.withColumn("x", newest.order_number(df, order)).collect()]
        for a, x in got:
            assert 0 <= x < 2**63
            for b, y in got:
                assert not before(a, b) or x <= y
    plain = df.where("yyyymmdd in ('20240101', '2024-01-01', '2024-01-02') and nsp06_word_cnt between -1 and 8000000")
    numbers = plain.select(newest.order_number(plain, ["yyyymmdd", "nsp06_word_cnt"]))
    assert numbers.distinct().count() == plain.count()


def test_columns_without_a_number(spark):
    df = spark.createDataFrame([(1.5, 1)], "a double, b int").withColumn("c", F.lit("2024-01-01").cast("date"))
    assert df.select(newest.order_number(df, ["a", "b"])).first()[0] == 0
    assert df.select(newest.order_number(df, ["c", "b"])).first()[0] > 0
    assert df.select(newest.order_number(df, ["x"])).first()[0] == 0


def test_newest_of_many_rows(spark):
    rng = random.Random(3)
    schema = "track_id long, yyyymmdd string, nsp06_word_cnt long, note string, n double"
    keys = [None, 1, 1, 1, 1, *range(2, 40)]
    rows = [
        (rng.choice(keys), rng.choice(DAYS[:8] + [None]), rng.choice(COUNTS), rng.choice(["x", "y", None]), rng.choice([0.5, 1.5]))
        for _ in range(3000)
    ]
    best = {}
    for r in rows:
        value = (r[1], r[2], r[3], r[4])
        if r[0] not in best or before(best[r[0]], value):
            best[r[0]] = value
    df = spark.createDataFrame(rows + rows[:500], schema)
    got = [tuple(r) for r in ops.dedupe_tracks(df).collect()]
    assert len(got) == len(best) and {r[0]: r[1:] for r in got} == best
    assert ops.dedupe_tracks(df).schema.fieldNames() == df.columns
    assert ops.dedupe_tracks(df.limit(0)).collect() == []
    by_note = ops.dedupe_tracks(df, order=["n", "note"])
    tops = df.groupBy("track_id").agg(F.max("n").alias("n"))
    assert by_note.join(tops, by_note.track_id.eqNullSafe(tops.track_id) & (by_note.n == tops.n)).count() == len(best)
    assert isinstance(by_note.schema["n"].dataType, T.DoubleType)
