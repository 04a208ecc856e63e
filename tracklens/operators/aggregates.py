"""Grouped lists, de-duplication and counts.

Every grouping here shrinks before it shuffles: equal values are counted, or the
better of two rows is picked, on the map side, so a heavy key sends few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.operators.filters import with_role
from tracklens.operators.joins import genre_join
from tracklens.operators.newest import newest_keys, newest_rows

def dedupe_tracks(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """One row per ``track_id``: the newest, with fixed tie-breaks."""
    return newest_rows(df, newest_keys(df, order=order), order=order)


def _counted_list(value: Column) -> Column:
    """Aggregate over (value, n) rows: the sorted values, each ``n`` times.

    A NULL value is skipped but its key keeps an (empty) list.
    """
    pair = F.struct(value.alias("v"), F.col("n").alias("n"))
    pairs = F.sort_array(F.collect_list(F.when(value.isNotNull(), pair)))
    return F.flatten(
        F.transform(pairs, lambda p: F.array_repeat(p["v"], p["n"].cast("int")))
    )


def vocal_artists(artists: DataFrame, sep: str = ",") -> DataFrame:
    """Sorted list of vocal artists per track; '' when no name is known."""
    counted = (
        with_role(artists).groupBy("track_id", "artist_text").agg(F.count("*").alias("n"))
    )
    names = _counted_list(F.col("artist_text"))
    return counted.groupBy("track_id").agg(F.concat_ws(sep, names).alias("artist_array"))


def _counted_genres(genre_map: DataFrame, genre: DataFrame) -> DataFrame:
    # Counting (track, genre) pairs before the names come in keeps the join
    # small and bounds a track's list by the number of genres.
    pairs = (
        genre_map.filter(F.col("svc_genre_id").isNotNull())
        .groupBy("track_id", "svc_genre_id")
        .agg(F.count("*").alias("n"))
    )
    return genre_join(pairs, genre.select("svc_genre_id", "svc_genre_nm"))


def track_genres(genre_map: DataFrame, genre: DataFrame, sep: str = ",") -> DataFrame:
    """Sorted list of genre names per track; '' when no name is known.

    Pairs without a track form a group of their own, here and in ``genre_listagg``.
    """
    names = _counted_list(F.col("svc_genre_nm"))
    return (
        _counted_genres(genre_map, genre)
        .groupBy("track_id")
        .agg(F.concat_ws(sep, names).alias("genre_array"))
    )


def genre_listagg(genre_map: DataFrame, genre: DataFrame, sep: str = ",") -> DataFrame:
    """Names and ids per track in list-aggregate style: NULL when all are NULL."""
    names = _counted_list(F.col("svc_genre_nm"))
    ids = _counted_list(F.col("svc_genre_id"))
    return (
        _counted_genres(genre_map, genre)
        .groupBy("track_id")
        .agg(names.alias("names"), ids.alias("ids"))
        .select(
            "track_id",
            F.when(F.size("names") > 0, F.array_join("names", sep)).alias("genre_array"),
            F.array_join(F.col("ids").cast("array<string>"), sep).alias("genre_id_array"),
        )
    )


def verdict_counts(df: DataFrame) -> DataFrame:
    """Tracks per verdict; a verdict nobody got is there with 0.

    Rows without a verdict count for neither.
    """
    return df.agg(
        F.count_if(F.col("verdict")).alias("yes"),
        F.count_if(~F.col("verdict")).alias("no"),
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit(True).alias("verdict"), F.col("yes").alias("n")),
                F.struct(F.lit(False).alias("verdict"), F.col("no").alias("n")),
            )
        )
    )


def stage_counts(**frames: DataFrame) -> DataFrame:
    """One (stage, n) row per frame."""
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(stage).alias("stage"), "n")
        for stage, df in frames.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def top_tracks(df: DataFrame, k: int) -> DataFrame:
    """The ``k`` most popular tracks, by id among equals."""
    return df.orderBy(F.col("pop_score").desc(), "track_id").limit(k)
