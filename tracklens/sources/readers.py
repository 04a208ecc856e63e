"""Sources. Schemas are given or all-string; none is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklens.constants import DAY_COLUMN, ERROR_PREFIX, TIMING_PHRASE
from tracklens.schemas import METRICS_SCHEMA, METRICS_SRC_SCHEMA


def read_table(spark: SparkSession, name: str, day: str | None = None) -> DataFrame:
    """A catalog table; with ``day`` only that partition of it."""
    table = spark.table(name)
    return table if day is None else table.filter(F.col(DAY_COLUMN) == day)


def read_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    """A metric file with a header row, every column as a string."""
    return spark.read.csv(path, header=True, inferSchema=False)


def read_metrics_src_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """The older metric files under their declared column types."""
    return spark.read.schema(METRICS_SRC_SCHEMA).csv(path, header=True, sep=sep)


def _whole_number(value: Column) -> Column:
    return F.trim(value).try_cast("bigint")


def read_track_id_list(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(ids, rejects) of a text with one id per line; blank lines are skipped."""
    lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    parsed = lines.select(_whole_number(F.col("value")).alias("track_id"), "value")
    ids = parsed.filter(F.col("track_id").isNotNull()).select("track_id")
    return ids, parsed.filter(F.col("track_id").isNull()).select("value")


def read_work_list(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(ids, rejects) of a work list with a ``track_id`` column.

    A list without that column is an error, one without rows is not.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False)
    if not raw.columns:
        nothing = spark.createDataFrame([], "track_id bigint, value string")
        return nothing.select("track_id"), nothing.select("value")
    if "track_id" not in raw.columns:
        raise ValueError(f"no track_id column in {path}: {raw.columns}")
    parsed = raw.select(
        _whole_number(F.col("track_id")).alias("track_id"), F.col("track_id").alias("value")
    )
    ids = parsed.filter(F.col("track_id").isNotNull()).select("track_id")
    return ids, parsed.filter(F.col("track_id").isNull()).select("value")


def read_logs(spark: SparkSession, glob: str) -> DataFrame:
    """(value, file_path) of every line of every file that ``glob`` meets."""
    return spark.read.text(glob).select(
        "value", F.col("_metadata.file_path").alias("file_path")
    )


def read_results_quarantine(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of result files that mix metrics with other lines.

    ``good`` has the metric columns. ``bad`` has track_id (where readable), kind
    ('timing', 'error' or 'malformed') and the line. Headers, blank lines and
    other comments belong to neither. Lines are parsed as an expression and not
    by the file reader, so both halves prune and filter freely without a cache.
    """
    corrupt = "_corrupt_record"
    schema = T.StructType(METRICS_SCHEMA.fields + [T.StructField(corrupt, T.StringType())])
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    line = F.trim("value")
    timing = line.contains(TIMING_PHRASE)
    parsed = (
        spark.read.text(path)
        .filter(F.length(line) > 0)
        .filter(~line.startswith("track_id"))
        .filter(~line.startswith("#") | timing)
        .select(
            "value",
            timing.alias("timing"),
            F.from_csv("value", ddl, {"mode": "PERMISSIVE"}).alias("row"),
        )
    )
    whole = F.col(f"row.{corrupt}").isNull() & F.col("row.track_id").isNotNull() & ~F.col("timing")
    kind = (
        F.when(F.col("timing"), "timing")
        .when(F.col("value").contains(ERROR_PREFIX), "error")
        .otherwise("malformed")
    )
    good = parsed.filter(whole).select(*[f"row.{c}" for c in METRICS_SCHEMA.names])
    bad = parsed.filter(~whole).select(
        F.col("row.track_id").alias("track_id"), kind.alias("kind"), F.col("value").alias("line")
    )
    return good, bad
