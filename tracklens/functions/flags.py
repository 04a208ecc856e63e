from pyspark.sql import Column
from pyspark.sql import functions as F

from tracklens.constants import VERDICT_SPEECH_SECONDS, VERDICT_UNIQUE_WORDS


def at_least_flag(value: Column, threshold: int) -> Column:
    """'Y' from ``threshold`` on, else 'N'; an unknown value is 'N'."""
    return F.when(value >= threshold, "Y").otherwise("N")


def words_verdict(unique_words: Column, threshold: int = VERDICT_UNIQUE_WORDS) -> Column:
    return unique_words >= threshold


def duration_verdict(segments: Column, seconds: float = VERDICT_SPEECH_SECONDS) -> Column:
    """True when all segments together last longer than ``seconds``."""
    total = F.aggregate(
        F.coalesce(segments, F.array()),
        F.lit(0.0),
        lambda acc, s: acc + F.coalesce(s["end"] - s["start"], F.lit(0.0)),
    )
    return total > F.lit(float(seconds))
