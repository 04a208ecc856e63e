"""DataFrame-to-DataFrame operators."""

from tracklens.operators.aggregates import (
    dedupe_tracks,
    genre_listagg,
    stage_counts,
    top_tracks,
    track_genres,
    verdict_counts,
    vocal_artists,
)
from tracklens.operators.excerpts import excerpt_ranges, excerpt_thirds
from tracklens.operators.filters import (
    cast_metrics,
    exclude_styles_strict,
    excluded_track_ids,
    genre_any,
    genre_substring,
    min_popularity,
    normalize_key,
    require_key,
    stat_projection,
    tier_flags,
    verdict,
    verdict_by_duration,
    with_day,
    with_role,
    with_run_date,
    without_lyrics,
)
from tracklens.operators.joins import (
    anti_excluded,
    catalog_join,
    genre_join,
    keep_without_lyrics,
    lyric_counts,
    not_processed,
)
from tracklens.operators.metrics import segment_metrics, segment_metrics_long
from tracklens.operators.scoring import row_by_row, score_batches, split_errors
from tracklens.operators.skew import expand_counts, heavy_keys, heavy_rows, keyed_join, use_all_cores
from tracklens.operators.verdict_log import parse_verdict_lines

__all__ = [name for name in dir() if not name.startswith("_")]
