"""Sinks. Table names are catalog names; paths are in a shared file system."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklens.constants import DAY_COLUMN
from tracklens.schemas import METRICS_SCHEMA, METRICS_SRC_SCHEMA
from tracklens.session import scratch_dir
from tracklens.sources.frequent import note_heavy_keys
from tracklens.sources.versions import replace_by_version


def write_single_csv(df: DataFrame, path: str, files: int = 1) -> int:
    """Write a CSV work list with header and return its rows; 0 rows write nothing.

    The list is one file unless ``files`` says otherwise; a folder of several, each
    with the header and from its own task, reads back as the one path it is.
    The rows are stored first and counted there, so they are worked out once.
    """
    rows = materialize(df, scratch_dir(df.sparkSession, "list"), "rows")
    n = rows.count()
    if n:
        rows.repartition(files).write.mode("overwrite").csv(path, header=True)
    return n


def write_daily(df: DataFrame, table: str, day: str, replace: str = "table") -> None:
    """Write one day's rows to a table partitioned by day.

    ``table`` replaces the whole table, so only this day remains; ``day``
    replaces only this day's partition.
    """
    spark = df.sparkSession
    rows = df.withColumn(DAY_COLUMN, F.lit(day))
    if replace == "table":
        rows.write.mode("overwrite").partitionBy(DAY_COLUMN).saveAsTable(table)
    elif replace == "day":
        if not spark.catalog.tableExists(table):
            rows.write.partitionBy(DAY_COLUMN).saveAsTable(table)
            return
        names = [c for c in spark.table(table).columns if c != DAY_COLUMN]
        spark.sql(
            f"INSERT OVERWRITE {table} PARTITION ({DAY_COLUMN} = :day) "
            "SELECT * FROM {rows}",
            args={"day": day},
            rows=df.select(*names),
        )
    else:
        raise ValueError(f"unknown replace mode: {replace}")


def append_positional(df: DataFrame, table: str) -> None:
    """Append by position: names are ignored, like a plain INSERT."""
    df.write.insertInto(table)


def append_by_name(df: DataFrame, table: str) -> None:
    """Append with columns matched by name, whatever their order."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.insertInto(table)


def replace_via_staging(df: DataFrame, target: str, staging: str, how: str = "copy") -> None:
    """Replace ``target`` by rows that are computed from it.

    Spark refuses to overwrite a table it is reading. ``switch`` writes the rows once, to a folder of
    their own, and points the target there in one statement (``replace_by_version``); ``staging`` is not
    used. ``copy`` writes them to ``staging`` and from there to ``target``, which is empty in between;
    ``staging`` stays, and has all rows if the job dies then. The target ends unpartitioned.
    """
    if how == "switch":
        replace_by_version(df, target)
    elif how == "copy":
        df.write.mode("overwrite").saveAsTable(staging)
        df.sparkSession.table(staging).write.mode("overwrite").saveAsTable(target)
    else:
        raise ValueError(f"unknown way: {how}")


def truncate_insert(df: DataFrame, table: str, atomic: bool = True) -> None:
    """Replace all rows of an existing table and keep its definition.

    ``atomic`` overwrites in one statement; otherwise the table is emptied
    first and is empty until the rows are in.
    """
    if not atomic:
        df.sparkSession.sql(f"TRUNCATE TABLE {table}")
    df.write.insertInto(table, overwrite=atomic)


def create_table_as(df: DataFrame, table: str) -> None:
    """Create ``table`` from a query; it must not exist."""
    df.write.mode("errorifexists").saveAsTable(table)


def write_bucketed(df: DataFrame, table: str, buckets: int, key: str = "track_id") -> None:
    """Write a table whose rows lie in ``buckets`` parts by ``key``, one file each.

    Tables with the same number of buckets by the track id, such as the target, the catalog, its lyric
    entries (by ``b_track_id``) and the genre map, are joined and grouped by it without moving a row. A
    number that gives files of 128 to 512 MB suits all of them; a version switch keeps the layout.
    Heavy whole numbers and strings are noted (``known_heavy_keys``), so that plans which know of none leave
    the rows in place.
    """
    rows = df.repartition(buckets, key)
    rows.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(table)
    if isinstance(df.schema[key].dataType, T.IntegralType | T.StringType):
        note_heavy_keys(df.sparkSession.table(table), table, key)


def ensure_metrics_table(spark: SparkSession, table: str, mode: str = "fixed") -> None:
    """Create the daily metric table unless it exists.

    Its whole numbers are BIGINT; ``mode="faithful"`` has INT, as ``cast_metrics`` does.
    """
    empty = spark.createDataFrame([], METRICS_SCHEMA)
    if mode == "faithful":
        whole = [f.name for f in METRICS_SCHEMA if f.dataType == T.LongType()]
        empty = empty.withColumns({c: F.col(c).cast("int") for c in whole})
    dated = empty.withColumn(DAY_COLUMN, F.lit(None).cast("string"))
    dated.write.format("parquet").partitionBy(DAY_COLUMN).mode("ignore").saveAsTable(table)


def create_metrics_src_table(spark: SparkSession, table: str, path: str, sep: str = ",") -> None:
    """Name the older metric files below ``path`` as an external CSV table."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in METRICS_SRC_SCHEMA)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING csv "
        f"OPTIONS (path '{path}', header 'true', delimiter '{sep}')"
    )


def materialize(df: DataFrame, root: str, name: str) -> DataFrame:
    """``df`` read back from Parquet below ``root``: its plan starts at those files.

    ``root`` must be in a file system that all executors share.
    """
    target = f"{root.rstrip('/')}/{name}.parquet"
    df.write.parquet(target, mode="overwrite")
    return df.sparkSession.read.schema(df.schema).parquet(target)
