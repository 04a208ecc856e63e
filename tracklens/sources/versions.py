"""Tables replaced as a whole, without a moment in which neither the old nor the new rows are there.

The rows of a new version are written to a folder of their own beside the table; nothing reads it yet.
One catalog statement then points the table there. A job that dies before it leaves the old table, one that
dies after it leaves the new one; what lies in folders nobody points to is deleted by the next switch. The
version before stays until then, so queries that are still reading it go on.

The table keeps its name, columns, properties and grants, and can be inserted into like any other.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.sources import files

_VERSIONS = "__versions"
_OLD = "__before_switch"


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    wanted = ("Location", "Provider", "Type", "Num Buckets", "Bucket Columns", "Sort Columns")
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {r["col_name"]: r["data_type"] for r in rows if r["col_name"] in wanted}


def buckets_of(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """Number of buckets and their columns; 0 and none for a table without."""
    about = _described(spark, table)
    return int(about.get("Num Buckets", 0)), _names(about.get("Bucket Columns", ""))


def _names(listed: str) -> list[str]:
    return [n.strip().strip("`") for n in listed.strip("[]").split(",") if n.strip()]


def _partitioned(spark: SparkSession, table: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(table))


def _home(location: str) -> str:
    """The folder that holds a table's versions."""
    location = location.rstrip("/")
    parent = location.rpartition("/")[0]
    return parent if parent.endswith(_VERSIONS) else location + _VERSIONS


def home_of(spark: SparkSession, table: str) -> str:
    """A folder name that stays the table's through all its versions."""
    return _home(_described(spark, table)["Location"]).removesuffix(_VERSIONS)


def recover(spark: SparkSession, table: str) -> None:
    """Put ``table`` back if a job died while it changed a partitioned table's definition."""
    if spark.catalog.tableExists(table + _OLD):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE {table + _OLD}")
        else:
            spark.sql(f"ALTER TABLE {table + _OLD} RENAME TO {table}")


def version_tag(spark: SparkSession, table: str) -> str | None:
    """The tag of the version that ``table`` points to; None before its first switch."""
    location = _described(spark, table)["Location"].rstrip("/")
    parent, _, name = location.rpartition("/")
    return name.rpartition("-")[0] if parent.endswith(_VERSIONS) else None


def write_version(df: DataFrame, table: str, tag: str = "v") -> str:
    """Write the rows of a new version of ``table`` and return their folder; the table does not change.

    ``df`` has the columns of the table, in any order, and may be computed from it; values are cast
    to the table's types. Rows of a bucketed table are written in its buckets.
    """
    spark = df.sparkSession
    now = spark.table(table).schema
    if sorted(now.fieldNames()) != sorted(df.columns):
        raise ValueError(f"a version of {table} needs its columns: {now.simpleString()}")
    about = _described(spark, table)
    path = f"{_home(about['Location'])}/{tag}-{uuid.uuid4().hex}"
    write = df.select(*(F.col(f.name).cast(f.dataType) for f in now)).write.format(about["Provider"])
    number, columns = buckets_of(spark, table)
    if not number:
        write.save(path)
        return path
    # Only a table can be written in buckets: this one is external, so its files stay when it goes.
    writing = f"{table}__writing"
    spark.sql(f"DROP TABLE IF EXISTS {writing}")
    write = write.bucketBy(number, *columns)
    if order := _names(about.get("Sort Columns", "")):
        write = write.sortBy(*order)
    write.option("path", path).saveAsTable(writing)
    spark.sql(f"DROP TABLE {writing}")
    return path


def switch_version(spark: SparkSession, table: str, path: str) -> None:
    """Point ``table`` to a folder of ``write_version``, by one statement, then clean up."""
    if _partitioned(spark, table):
        _switch_definition(spark, table, path)
        return
    about = _described(spark, table)
    before = about["Location"].rstrip("/")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    home = _home(path)
    kept = {path.rpartition("/")[2], before.rpartition("/")[2]}
    for folder in files.children(spark, home):
        if folder.rpartition("/")[2] not in kept:
            files.delete(spark, folder)
    if about["Type"] == "MANAGED" and before.rpartition("/")[0] == home:
        # Where the table lay before its first switch; an external table's folder is its owner's.
        files.delete(spark, home.removesuffix(_VERSIONS))


def _switch_definition(spark: SparkSession, table: str, path: str) -> None:
    """A partitioned table becomes an unpartitioned one at ``path``.

    The catalog has no one statement for that: the old table steps aside, the new one takes its name, and
    ``recover`` puts the old one back if the job dies between the two. The new one is external.
    """
    provider = _described(spark, table)["Provider"]
    new = f"{table}__next"
    spark.sql(f"DROP TABLE IF EXISTS {new}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(table).schema)
    spark.sql(f"CREATE TABLE {new} ({columns}) USING {provider} LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {table} RENAME TO {table + _OLD}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    spark.sql(f"DROP TABLE {table + _OLD}")


def replace_by_version(df: DataFrame, table: str, tag: str = "v") -> None:
    """Replace all rows of ``table`` by ``df``, which may be computed from it; create it if it is not there."""
    spark = df.sparkSession
    recover(spark, table)
    if spark.catalog.tableExists(table):
        switch_version(spark, table, write_version(df, table, tag))
    else:
        df.write.saveAsTable(table)
