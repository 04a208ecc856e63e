"""Filters, casts and projections; none of them shuffles but the distinct ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklens.constants import (
    DAY_COLUMN,
    DOUBLE_METRICS,
    DOUBLE_METRICS_AS_SPELLED,
    EXCLUDED_STYLE_IDS,
    MIN_POP_SCORE,
    REPORT_GENRE_IDS,
    TIER_THRESHOLDS,
    VERDICT_SPEECH_SECONDS,
    VERDICT_UNIQUE_WORDS,
    VOCAL_ROLE,
)
from tracklens.functions import at_least_flag, duration_verdict, run_date, words_verdict


def min_popularity(df: DataFrame, threshold: float = MIN_POP_SCORE) -> DataFrame:
    return df.filter(F.col("pop_score") >= F.lit(float(threshold)))


def without_lyrics(df: DataFrame) -> DataFrame:
    """Tracks with neither plain nor synchronised lyrics; unknown flags fail."""
    return df.filter((F.col("lyric_yn") == "N") & (F.col("sync_lyric_yn") == "N"))


def with_role(df: DataFrame, role: str = VOCAL_ROLE) -> DataFrame:
    return df.filter(F.col("artist_role_type") == role)


def _has_style(ids: Sequence[int]) -> Column:
    return F.arrays_overlap("style_id_list", F.array(*[F.lit(int(i)) for i in ids]))


def exclude_styles_strict(
    df: DataFrame, ids: Sequence[int] = EXCLUDED_STYLE_IDS
) -> DataFrame:
    """Keep tracks without a style list or surely without any of ``ids``.

    A list with a NULL element and no hit compares as unknown and is dropped.
    """
    return df.filter(F.col("style_id_list").isNull() | ~_has_style(ids))


def excluded_track_ids(
    df: DataFrame, ids: Sequence[int] = EXCLUDED_STYLE_IDS
) -> DataFrame:
    """Ids of tracks that surely have one of ``ids``; unknown is not excluded."""
    return df.filter(_has_style(ids)).select("track_id").distinct()


def require_key(df: DataFrame, key: str = "track_id") -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def genre_substring(
    df: DataFrame,
    patterns: Sequence[int | str] = REPORT_GENRE_IDS,
    column: str = "genre_id_array",
) -> DataFrame:
    """Any pattern inside the comma list, so '19' also meets '119'."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.col(column).ilike(f"%{p}%")
    return df.filter(hit)


def genre_any(
    df: DataFrame,
    ids: Sequence[int | str] = REPORT_GENRE_IDS,
    column: str = "genre_id_array",
) -> DataFrame:
    """Like ``genre_substring`` but comparing whole ids."""
    wanted = F.array(*[F.lit(str(i)) for i in ids])
    return df.filter(F.arrays_overlap(F.split(column, ","), wanted))


def normalize_key(df: DataFrame, key: str = "track_id") -> DataFrame:
    return df.withColumn(key, F.col(key).cast("bigint"))


def whole_number(value: Column, mode: str = "fixed") -> Column:
    """A text as BIGINT, or INT in mode ``faithful``; NULL if it does not fit."""
    kind = "bigint" if mode == "fixed" else "int"
    # Whole numbers first: going through a double would blur large ids.
    return F.coalesce(value.try_cast(kind), value.try_cast("double").try_cast(kind))


def cast_metrics(
    df: DataFrame, double_cols: Sequence[str] | None = None, mode: str = "fixed"
) -> DataFrame:
    """Cast all-string metric columns by name; a value that fails gives NULL.

    ``fixed`` reads every duration as a double and whole numbers as BIGINT.
    ``faithful`` keeps the original contract: INT, under which larger ids become
    NULL, and a column list by which ``total_duration`` is cut to whole seconds.
    """
    if mode not in ("fixed", "faithful"):
        raise ValueError(f"unknown mode: {mode}")
    if double_cols is None:
        double_cols = DOUBLE_METRICS if mode == "fixed" else DOUBLE_METRICS_AS_SPELLED


    def cast(name: str) -> Column:
        value = F.col(name)
        kept = value.try_cast("double") if name in double_cols else whole_number(value, mode)
        return kept.alias(name)

    return df.select(*[cast(c) for c in df.columns])


def with_day(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn(DAY_COLUMN, F.lit(day))


def with_run_date(df: DataFrame, ts_col: str) -> DataFrame:
    instant = isinstance(df.schema[ts_col].dataType, T.TimestampType)
    return df.withColumn("run_date", run_date(F.col(ts_col), instant=instant))


def tier_flags(df: DataFrame, thresholds: Sequence[int] = TIER_THRESHOLDS) -> DataFrame:
    """One 'Y'/'N' column ``nsp06uc{t}`` per threshold on the distinct words."""
    words = F.col("nsp06_unique_word_cnt")
    return df.select("*", *[at_least_flag(words, t).alias(f"nsp06uc{t}") for t in thresholds])


def stat_projection(
    df: DataFrame, thresholds: Sequence[int] = TIER_THRESHOLDS
) -> DataFrame:
    """The columns and types of the statistics table; texts keep their full length."""
    texts = ["track_title", "artist_array", "genre_array", "lyric_yn"]
    counts = ["nsp06_word_cnt", "nsp06_unique_word_cnt"]
    return tier_flags(df, thresholds).select(
        F.col("track_id").cast("bigint").alias("track_id"),
        *[F.col(c).cast("string").alias(c) for c in texts],
        *[F.col(c).cast("bigint").alias(c) for c in counts],
        *[f"nsp06uc{t}" for t in thresholds],
    )


def verdict(df: DataFrame, threshold: int = VERDICT_UNIQUE_WORDS) -> DataFrame:
    words = F.col("nsp06_unique_word_cnt")
    return df.withColumn("verdict", words_verdict(words, threshold))


def verdict_by_duration(
    df: DataFrame, seconds: float = VERDICT_SPEECH_SECONDS
) -> DataFrame:
    return df.withColumn("verdict", duration_verdict(F.col("segments"), seconds))
