"""Reading verdicts back from the lines of a run log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.constants import DETECTED_PHRASE, NOT_DETECTED_PHRASE


def parse_verdict_lines(lines: DataFrame) -> DataFrame:
    """(track_id, verdict) of the lines that carry a verdict.

    The record after the phrase is searched for its track id, never evaluated.
    A verdict line without a readable id keeps its row, with a NULL id.
    """
    line = F.col("value")
    detected = line.contains(DETECTED_PHRASE)
    rejected = line.contains(NOT_DETECTED_PHRASE)
    phrase = F.when(detected, DETECTED_PHRASE + ": ").otherwise(NOT_DETECTED_PHRASE + ": ")
    record = F.split_part(line, phrase, F.lit(2))
    track_id = F.regexp_extract(record, r"""['"]track_id['"]\s*:\s*['"]?(-?\d+)""", 1)
    return lines.filter(detected | rejected).select(
        track_id.try_cast("bigint").alias("track_id"), detected.alias("verdict")
    )
