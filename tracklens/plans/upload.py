"""Transcripts to metrics, and metric files to the daily table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.operators.filters import cast_metrics, require_key, whole_number
from tracklens.operators.metrics import segment_metrics
from tracklens.plans.audit import Audit
from tracklens.sources.readers import read_metrics_csv, read_table
from tracklens.sources.writers import write_daily


def track_metrics(transcripts: DataFrame) -> DataFrame:
    """The nine metric columns of (track_id, text, segments) transcripts; map-only."""
    return segment_metrics(transcripts)


def split_bad_keys(
    raw: DataFrame, mode: str = "fixed", key: str = "track_id"
) -> tuple[DataFrame, DataFrame]:
    """(cast rows, untouched rows whose key is no number or too large for the mode)."""
    bad = raw.filter(whole_number(F.col(key), mode).isNull())
    return require_key(cast_metrics(raw, mode=mode), key), bad


def upload_metrics(
    spark: SparkSession,
    path: str,
    table: str,
    day: str,
    mode: str = "fixed",
    replace: str = "table",
    audit: Audit | None = None,
    bad_keys: str | None = None,
) -> None:
    """Load a metric file into the daily table; any failure raises.

    With ``bad_keys``, a folder, rows whose track id cannot be read are written there
    as they came and not loaded. Without it they are loaded with a NULL key.
    """
    raw = read_metrics_csv(spark, path)
    if bad_keys is None:
        write_daily(cast_metrics(raw, mode=mode), table, day, replace)
    else:
        rows, bad = split_bad_keys(raw, mode)
        bad.write.mode("overwrite").csv(bad_keys, header=True)
        write_daily(rows, table, day, replace)
    if audit is not None:
        loaded = read_table(spark, table, day).count()
        if bad_keys is not None:
            audit.note("bad_key", raw.count() - loaded)
        audit.note("uploaded", loaded)
