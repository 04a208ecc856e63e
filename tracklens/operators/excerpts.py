"""One-minute excerpts: of sample arrays, or as ranges without moving samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.constants import KEEP_WHOLE_BELOW_SECONDS, SAMPLE_RATE, SLICE_SECONDS
from tracklens.functions import excerpt, excerpt_bounds


def _sizes(rate: int, keep_s: int, slice_s: int) -> tuple[int, int]:
    if keep_s < 3 * slice_s:
        raise ValueError("both slices must fit behind the third points: keep_s >= 3 * slice_s")
    return keep_s * rate, slice_s * rate


def excerpt_thirds(
    df: DataFrame,
    col: str,
    rate: int = SAMPLE_RATE,
    keep_s: int = KEEP_WHOLE_BELOW_SECONDS,
    slice_s: int = SLICE_SECONDS,
) -> DataFrame:
    """Cut the sample array ``col`` to its excerpt."""
    keep, size = _sizes(rate, keep_s, slice_s)
    return df.withColumn(col, excerpt(F.col(col), keep, size))


def excerpt_ranges(
    df: DataFrame,
    n_col: str,
    rate: int = SAMPLE_RATE,
    keep_s: int = KEEP_WHOLE_BELOW_SECONDS,
    slice_s: int = SLICE_SECONDS,
) -> DataFrame:
    """The excerpt as rows (track_id, part, start_sample, end_sample), for loaders
    that read only those samples; ``n_col`` is the number of samples."""
    keep, size = _sizes(rate, keep_s, slice_s)
    return df.select("track_id", F.inline(excerpt_bounds(F.col(n_col), keep, size)))
