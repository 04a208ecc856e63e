"""The published statistics and the two ad-hoc reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.constants import MIN_POP_SCORE, REPORT_GENRE_IDS, TIER_THRESHOLDS
from tracklens.operators.aggregates import (
    genre_listagg,
    track_genres,
    verdict_counts,
    vocal_artists,
)
from tracklens.operators.filters import (
    genre_any,
    genre_substring,
    min_popularity,
    require_key,
    stat_projection,
    without_lyrics,
)
from tracklens.operators.skew import heavy_rows, keyed_join
from tracklens.operators.verdict_log import parse_verdict_lines
from tracklens.sources.readers import read_logs


def track_statistics(
    target: DataFrame,
    mcp_track: DataFrame,
    artists: DataFrame,
    genre_map: DataFrame,
    genre: DataFrame,
    thresholds: Sequence[int] = TIER_THRESHOLDS,
    heavy: Mapping[str, dict] | None = None,
) -> DataFrame:
    """Title, vocal artists, genres, lyric flag and word tiers per track.

    ``target`` has one row per track, as the refresh leaves it. Genres and
    catalog entries both join on the track id and share one shuffle unless the
    entries have heavy keys; only the artists need another key. Groups without a track
    can join nothing, so they are not made. ``heavy`` gives what is known of heavy keys by table,
    here of ``mcp_track`` (``b_track_id``); other searches run with the rows. Planning starts no job.
    """
    heavy = heavy or {}
    tracks = target.select("track_id", "nsp06_word_cnt", "nsp06_unique_word_cnt")
    genres = track_genres(require_key(genre_map), genre)
    with_genres = keyed_join(tracks, genres, "track_id", how="left", many="none")
    entries = mcp_track.select(
        F.col("track_id").alias("mcp_track_id"), "b_track_id", "track_title", "lyric_yn"
    )
    titled = keyed_join(
        with_genres, entries, "track_id", "b_track_id", "left", many="right",
        right_heavy=heavy.get("mcp_track"),
    )
    # Tracks without a catalog entry have no artists; a hash in place of the
    # missing key keeps them from gathering in one task, and what it may meet by
    # chance is taken out again.
    known = F.col("mcp_track_id").isNotNull()
    rows = keyed_join(
        titled.withColumn("artist_key", F.coalesce("mcp_track_id", F.xxhash64("track_id"))),
        vocal_artists(require_key(artists)),
        "artist_key",
        "track_id",
        "left",
        # An entry comes once per track it belongs to, so its id does not repeat.
        many="none",
    ).withColumn("artist_array", F.when(known, F.col("artist_array")))
    return stat_projection(rows, thresholds)


def candidate_report(
    track_all: DataFrame,
    mcp_track: DataFrame,
    genre_map: DataFrame,
    genre: DataFrame,
    threshold: float = MIN_POP_SCORE,
    genre_ids: Sequence[int | str] = REPORT_GENRE_IDS,
    whole_ids: bool = False,
    heavy: Mapping[str, dict] | None = None,
) -> DataFrame:
    """Popular tracks without lyrics in the given genres, most popular first.

    Genre ids match as substrings of the id list unless ``whole_ids`` is set. ``heavy`` gives what is
    known of heavy keys by table: ``track_all``, ``genre_map`` (``track_id``) and ``mcp_track``
    (``b_track_id``); other searches run with the rows. Planning starts no job.
    """
    heavy = heavy or {}
    pick = genre_any if whole_ids else genre_substring
    tracks = min_popularity(track_all, threshold).select("track_id", "track_nm", "pop_score")
    # Lists are made for popular tracks alone.
    wanted = keyed_join(
        genre_map, tracks.select("track_id").distinct(), "track_id", how="left_semi",
        left_heavy=heavy.get("genre_map"),
    )
    genres = pick(genre_listagg(wanted, genre), genre_ids).drop("genre_id_array")
    # Both joins of the tracks share one search.
    repeated = heavy.get("track_all", heavy_rows(tracks, "track_id"))
    entries = without_lyrics(mcp_track).select(
        "b_track_id", "track_artist_name_list", "lyric_yn", "sync_lyric_yn"
    )
    rows = keyed_join(
        keyed_join(tracks, genres, "track_id", left_heavy=repeated),
        entries,
        "track_id",
        "b_track_id",
        many="both",
        left_heavy=repeated,
        right_heavy=heavy.get("mcp_track"),
    )
    return rows.select(
        "track_id",
        "track_nm",
        "track_artist_name_list",
        "lyric_yn",
        "sync_lyric_yn",
        "genre_array",
        "pop_score",
    ).orderBy(F.col("pop_score").desc(), "track_id")


def log_verdict_summary(spark: SparkSession, glob: str) -> DataFrame:
    """(verdict, n) over all run logs that ``glob`` meets."""
    return verdict_counts(parse_verdict_lines(read_logs(spark, glob)))
