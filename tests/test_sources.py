import pytest
from pyspark.sql import functions as F

from tracklens import sources
from tracklens.constants import METRIC_COLUMNS
from tracklens.schemas import METRICS_SRC_SCHEMA
from tracklens.session import scratch_dir


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_metrics_csv_is_all_strings(spark, tmp_path):
    path = write(tmp_path / "m.csv", "track_id,total_duration\n1,59.98\n2,\n")
    df = sources.read_metrics_csv(spark, path)
    assert [t for _, t in df.dtypes] == ["string", "string"]
    assert rows(df) == ["('1', '59.98')", "('2', None)"]


def test_declared_csv(spark, tmp_path):
    head = ";".join(METRICS_SRC_SCHEMA.names)
    path = write(tmp_path / "m.csv", f"{head}\n1;2;3;4.5;1.5;0.3;1;2;2\n")
    df = sources.read_metrics_src_csv(spark, path, sep=";")
    assert df.schema == METRICS_SRC_SCHEMA
    assert tuple(df.first()) == (1, 2, 3, 4.5, 1.5, 0.3, 1, 2, 2)


def test_id_list(spark, tmp_path):
    path = write(tmp_path / "ids.txt", " 12 \n\n   \n7\nabc\n12\n")
    ids, rejects = sources.read_track_id_list(spark, path)
    assert rows(ids) == ["(12,)", "(12,)", "(7,)"] and rows(rejects) == ["('abc',)"]


def test_work_list(spark, tmp_path):
    ids, rejects = sources.read_work_list(
        spark, write(tmp_path / "a.csv", "n,track_id\n1,10\n2,x\n3,11\n")
    )
    assert rows(ids) == ["(10,)", "(11,)"] and rows(rejects) == ["('x',)"]
    with pytest.raises(ValueError, match="track_id"):
        sources.read_work_list(spark, write(tmp_path / "b.csv", "id\n1\n"))
    for name, text in (("c.csv", "track_id\n"), ("d.csv", "")):
        ids, rejects = sources.read_work_list(spark, write(tmp_path / name, text))
        assert ids.count() == 0 and rejects.count() == 0


def test_logs_by_glob(spark, tmp_path):
    write(tmp_path / "a.log", "one\ntwo\n")
    write(tmp_path / "b.log", "three\n")
    write(tmp_path / "c.txt", "no\n")
    df = sources.read_logs(spark, str(tmp_path / "*.log"))
    assert sorted(r["value"] for r in df.collect()) == ["one", "three", "two"]
    assert {r["file_path"].rsplit("/", 1)[1] for r in df.collect()} == {"a.log", "b.log"}


def test_quarantine(spark, tmp_path):
    head = ",".join(["track_id_src"] + METRIC_COLUMNS[1:])
    write(
        tmp_path / "a.csv",
        f'{head}\n1,2,3,4.5,1.5,0.3,1,2,2\n5,"ERROR: load, failed"\n\n# Total Processing Time: 0:01\n',
    )
    write(
        tmp_path / "b.csv",
        f"{head}\n6,2,3,4.5,1.5,0.3,1,2,2\nx,2,3,4.5,1.5,0.3,1,2,2\n# note\nTotal Processing Time: 0:02\n",
    )
    good, bad = sources.read_results_quarantine(spark, str(tmp_path))
    assert sorted(r["track_id"] for r in good.collect()) == [1, 6]
    assert good.count() == 2 and bad.count() == 4
    kinds = sorted((r["kind"], r["track_id"]) for r in bad.select("kind", "track_id").collect() if r["kind"] != "timing")
    assert kinds == [("error", 5), ("malformed", None)]


def test_single_csv(spark, tmp_path):
    df = spark.range(0, 25, 1, 5).toDF("track_id")
    path = str(tmp_path / "one")
    assert sources.write_single_csv(df, path) == 25
    assert len(list((tmp_path / "one").glob("part-*.csv"))) == 1
    ids, _ = sources.read_work_list(spark, path)
    assert ids.count() == 25
    assert sources.write_single_csv(df, str(tmp_path / "many"), files=3) == 25
    assert len(list((tmp_path / "many").glob("part-*.csv"))) == 3
    ids, _ = sources.read_work_list(spark, str(tmp_path / "many"))
    assert sorted(r[0] for r in ids.collect()) == list(range(25))
    assert sources.write_single_csv(df.limit(0), str(tmp_path / "none")) == 0
    assert not (tmp_path / "none").exists()


def test_daily_table_modes(spark, database):
    df = spark.range(3).toDF("track_id")
    days = lambda t: sorted({r[0] for r in spark.table(t).select("yyyymmdd").collect()})
    whole, each = f"{database}.whole", f"{database}.each"
    for day in ("20240101", "20240102"):
        sources.write_daily(df, whole, day)
        sources.write_daily(df, each, day, replace="day")
    assert days(whole) == ["20240102"] and days(each) == ["20240101", "20240102"]
    sources.write_daily(df.limit(1), each, "20240101", replace="day")
    assert spark.table(each).count() == 4
    assert sources.read_table(spark, each, "20240101").count() == 1
    with pytest.raises(ValueError):
        sources.write_daily(df, each, "20240101", replace="hour")


def test_append_by_position_and_by_name(spark, database):
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(20, 10)], "b int, a int")
    for name, append, second in (
        ("pos", sources.append_positional, (20, 10)),
        ("name", sources.append_by_name, (10, 20)),
    ):
        a.write.saveAsTable(f"{database}.{name}")
        append(b, f"{database}.{name}")
        assert sorted(map(tuple, spark.table(f"{database}.{name}").collect())) == [(1, 2), second]


@pytest.mark.parametrize("how", ["copy", "switch"])
def test_replace_from_itself(spark, database, how):
    target = f"{database}.target_{how}"
    spark.range(10).withColumn("yyyymmdd", F.lit("20240101")).write.partitionBy(
        "yyyymmdd"
    ).saveAsTable(target)
    kept = spark.table(target).filter("id >= 5")
    sources.replace_via_staging(kept, target, f"{database}.staging_{how}", how)
    assert sorted(r["id"] for r in spark.table(target).collect()) == [5, 6, 7, 8, 9]
    assert all(not c.isPartition for c in spark.catalog.listColumns(target))


@pytest.mark.parametrize("atomic", [True, False])
def test_truncate_insert(spark, database, atomic):
    name = f"{database}.stat_{str(atomic).lower()}"
    sources.create_table_as(spark.range(5), name)
    sources.truncate_insert(spark.range(7, 9), name, atomic)
    assert sorted(r["id"] for r in spark.table(name).collect()) == [7, 8]
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        sources.create_table_as(spark.range(5), name)


def test_ensure_metrics_table(spark, database):
    name = f"{database}.daily"
    sources.ensure_metrics_table(spark, name)
    sources.ensure_metrics_table(spark, name)
    assert spark.table(name).columns == METRIC_COLUMNS + ["yyyymmdd"]
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["yyyymmdd"]
    assert dict(spark.table(name).dtypes)["track_id"] == "bigint"
    sources.ensure_metrics_table(spark, f"{database}.older", mode="faithful")
    assert dict(spark.table(f"{database}.older").dtypes)["track_id"] == "int"


def test_materialize_cuts_lineage(spark, tmp_path):
    df = spark.range(5).groupBy("id").count()
    back = sources.materialize(df, str(tmp_path), "counts")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and back.count() == 5


def test_scratch_folders_are_new_and_shared(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(root)
