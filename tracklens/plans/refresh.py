"""Appending a day to the target table and rebuilding it filtered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.constants import EXCLUDED_STYLE_IDS
from tracklens.operators.filters import excluded_track_ids, normalize_key
from tracklens.operators.joins import lyric_counts
from tracklens.operators.newest import newest_keys, newest_rows
from tracklens.plans.audit import Audit
from tracklens.session import apply_runtime_options, scratch_dir
from tracklens.sources.writers import append_positional, materialize


def append_source(source: DataFrame, target: str) -> None:
    """Append the daily rows to ``target`` by position.

    A re-run appends them again; the refresh removes such copies.
    """
    append_positional(normalize_key(source), target)


def with_source(target: DataFrame, source: DataFrame) -> DataFrame:
    """``target`` and the daily rows behind it, matched by position like an append."""
    rows = normalize_key(source)
    cast = [F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(rows.columns, target.schema, strict=True)]
    return target.union(rows.select(*cast))


def track_keys(
    target: DataFrame,
    track_all: DataFrame,
    mcp_track: DataFrame,
    style_ids: Sequence[int] = EXCLUDED_STYLE_IDS,
    lyric_key: str = "track_id",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """What the refresh has to know of each track of ``target``, without its rows.

    ``newest_keys`` and ``excluded``, whether the track is in an excluded style, ``lyric_rows``, how
    often the plain join to the lyric table would return a row of it, and ``kept``.
    """
    excluded = excluded_track_ids(track_all, style_ids).withColumn("excluded", F.lit(True))
    keys = newest_keys(target, order=order).join(excluded, "track_id", "left").join(
        lyric_counts(mcp_track, lyric_key), F.col("track_id") == F.col("lyric_key"), "left"
    )
    keys = keys.drop("lyric_key").withColumns({
        "excluded": F.col("excluded").isNotNull(),
        "lyric_rows": F.coalesce(F.col("lyric_rows"), F.lit(1)),
    })
    kept = ~F.col("excluded") & (F.col("lyric_rows") > 0) & F.col("track_id").isNotNull()
    return keys.withColumn("kept", kept)


def refresh_target(
    target: DataFrame,
    track_all: DataFrame,
    mcp_track: DataFrame,
    style_ids: Sequence[int] = EXCLUDED_STYLE_IDS,
    lyric_key: str = "track_id",
    order: Sequence[str] | None = None,
    audit: Audit | None = None,
    in_place: bool = False,
) -> DataFrame:
    """One row per track of ``target`` that is in no excluded style and not
    known to have lyrics.

    Both filters look at the track id alone, so they meet one narrow row per track, and whole
    rows take part in a single hash join, with the keys that stay. With an ``audit`` those
    narrow rows are written first and counted there: the counts are those of rows that were
    committed once, however often a task ran, and nothing is worked out twice. With ``in_place``
    the target is in buckets by track id and its rows are not moved.
    """
    apply_runtime_options(target.sparkSession)
    keys = track_keys(target, track_all, mcp_track, style_ids, lyric_key, order)
    if audit is not None:
        spark = target.sparkSession
        keys = materialize(keys, scratch_dir(spark, "refresh"), "keys")
        excluded = excluded_track_ids(track_all, style_ids).agg(F.count("*").alias("n"))
        audit.note("excluded", excluded.first()["n"])
        for row in _key_counts(keys).collect():
            audit.note(row["stage"], row["n"])
    return newest_rows(target, keys.where("kept"), order=order, in_place=in_place)


def _key_counts(keys: DataFrame) -> DataFrame:
    """(stage, n) from ``track_keys``."""

    def total(when, value):
        return F.coalesce(F.sum(F.when(when, value)), F.lit(0))

    styled = ~F.col("excluded")
    stages = {
        "source": total(F.lit(True), F.col("n_rows")),
        "after_style": total(styled, F.col("n_rows")),
        "after_lyric": total(styled, F.col("n_rows") * F.col("lyric_rows")),
        "after_dedupe": F.count_if("kept"),
    }
    pairs = [F.struct(F.lit(s).alias("stage"), F.col(s).alias("n")) for s in stages]
    return keys.agg(*[v.alias(s) for s, v in stages.items()]).select(F.inline(F.array(*pairs)))


def audit_counts(
    target: DataFrame,
    track_all: DataFrame,
    mcp_track: DataFrame,
    style_ids: Sequence[int] = EXCLUDED_STYLE_IDS,
    lyric_key: str = "track_id",
) -> DataFrame:
    """(stage, n) of the refresh without running it: one pass over the keys."""
    excluded = excluded_track_ids(track_all, style_ids).agg(F.count("*").alias("n"))
    keys = track_keys(target, track_all, mcp_track, style_ids, lyric_key)
    return _key_counts(keys).unionByName(excluded.select(F.lit("excluded").alias("stage"), "n"))
