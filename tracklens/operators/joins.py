"""The joins of the daily batch. Filter-type joins return each input row at
most once, and their look-up side is reduced to one row per key first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.operators.skew import keyed_join


def catalog_join(track_all: DataFrame, mcp_track: DataFrame) -> DataFrame:
    """Catalog tracks with their entries in the lyric catalog (inner join).

    The own id of the second table is kept as ``mcp_track_id``.
    """
    entries = mcp_track.withColumnRenamed("track_id", "mcp_track_id")
    return keyed_join(track_all, entries, "track_id", "b_track_id", "inner", many="both")


def genre_join(genre_map: DataFrame, genre: DataFrame) -> DataFrame:
    """Genre names for each (track, genre) pair; unknown genres fall out."""
    return keyed_join(genre_map, genre, "svc_genre_id", how="inner", many="left")


def not_processed(df: DataFrame, done: DataFrame) -> DataFrame:
    """Rows whose track is not in ``done``; rows without a key stay."""
    seen = done.select("track_id").distinct()
    return keyed_join(df, seen, "track_id", how="left_anti", many="left")


def anti_excluded(df: DataFrame, excluded: DataFrame) -> DataFrame:
    """Rows whose track is not in ``excluded``; rows without a key stay."""
    return not_processed(df, excluded)


def lyric_counts(lyric: DataFrame, lyric_key: str = "track_id") -> DataFrame:
    """Per key the number of entries that say, or by default mean, no lyrics."""
    no_lyrics = F.coalesce(F.col("lyric_yn"), F.lit("N")) == "N"
    return (
        lyric.select(F.col(lyric_key).alias("lyric_key"), no_lyrics.alias("no_lyrics"))
        .filter(F.col("lyric_key").isNotNull())
        .groupBy("lyric_key")
        .agg(F.count_if("no_lyrics").alias("lyric_rows"))
    )


def keep_without_lyrics(
    df: DataFrame, lyric: DataFrame, lyric_key: str = "track_id"
) -> DataFrame:
    """Rows with no lyric entry, or at least one entry without lyrics.

    A left join to the raw entries would repeat a row once per such entry. Here
    it comes once, and ``lyric_rows`` says how often it would have come.
    """
    joined = keyed_join(
        df, lyric_counts(lyric, lyric_key), "track_id", "lyric_key", "left", many="left"
    )
    rows = F.coalesce(F.col("lyric_rows"), F.lit(1))
    return joined.withColumn("lyric_rows", rows).filter(F.col("lyric_rows") > 0)
