"""Choosing the tracks that still need a transcript."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.constants import EXCLUDED_STYLE_IDS, MIN_POP_SCORE
from tracklens.operators.filters import (
    exclude_styles_strict,
    min_popularity,
    require_key,
    without_lyrics,
)
from tracklens.operators.skew import expand_counts
from tracklens.session import apply_runtime_options


def candidate_counts(
    track_all: DataFrame,
    mcp_track: DataFrame,
    done: DataFrame,
    threshold: float = MIN_POP_SCORE,
    style_ids: Sequence[int] = EXCLUDED_STYLE_IDS,
) -> DataFrame:
    """(track_id, n): each candidate and how often the joins would repeat it.

    All three sides shrink to one row per track on the map side and shuffle
    once, on the track id; both joins then reuse that partitioning, and no key
    is heavy any more.
    """
    apply_runtime_options(track_all.sparkSession)
    popular = min_popularity(require_key(track_all), threshold)
    tracks = (
        exclude_styles_strict(popular, style_ids)
        .groupBy("track_id")
        .agg(F.count("*").alias("n_tracks"))
    )
    entries = (
        without_lyrics(require_key(mcp_track, "b_track_id"))
        .groupBy(F.col("b_track_id").alias("track_id"))
        .agg(F.count("*").alias("n_entries"))
    )
    seen = done.select("track_id").distinct()
    return (
        tracks.join(seen, "track_id", "left_anti")
        .join(entries, "track_id")
        .select("track_id", (F.col("n_tracks") * F.col("n_entries")).alias("n"))
    )


def create_candidates(
    track_all: DataFrame,
    mcp_track: DataFrame,
    done: DataFrame,
    threshold: float = MIN_POP_SCORE,
    style_ids: Sequence[int] = EXCLUDED_STYLE_IDS,
) -> DataFrame:
    """Ids of popular tracks without lyrics, outside ``style_ids``, not in ``done``.

    A track comes once per pair of catalog rows; nothing is de-duplicated.
    """
    counts = candidate_counts(track_all, mcp_track, done, threshold, style_ids)
    return expand_counts(counts, "n")
