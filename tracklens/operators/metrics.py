"""Speech metrics of a transcript, from nested segments or one row per segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.constants import METRIC_COLUMNS, NO_SPEECH_LIMIT
from tracklens.functions import tokens


def _is_speech(prob: Column) -> Column:
    """A segment counts as speech below the limit; no probability means speech."""
    return F.coalesce(prob, F.lit(0.0)) < F.lit(NO_SPEECH_LIMIT)


def _ratio(part: Column, total: Column) -> Column:
    return F.when(total > 0, part / total).otherwise(F.lit(0.0))


def segment_metrics(df: DataFrame) -> DataFrame:
    """The nine metric columns from (track_id, text, segments); map-only.

    Each stage adds what the next one needs, so the kept segments and the word
    list are worked out once per row.
    """
    staged = (
        df.select(
            "track_id",
            F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("text_length"),
            F.coalesce(F.col("segments"), F.array()).alias("segments"),
        )
        .withColumn(
            "speech", F.filter("segments", lambda s: _is_speech(s["no_speech_prob"]))
        )
        .withColumn("words", tokens(F.array_join(F.col("speech")["text"], " ")))
    )
    total = F.coalesce(F.try_element_at("segments", F.lit(-1))["end"], F.lit(0.0))
    spoken = F.aggregate(
        "speech",
        F.lit(0.0),
        # A segment without a time lasts 0 s.
        lambda acc, s: acc + F.coalesce(s["end"] - s["start"], F.lit(0.0)),
    )
    return staged.select(
        "track_id",
        "text_length",
        F.size("segments").cast("bigint").alias("all_seg_cnt"),
        total.alias("total_duration"),
        spoken.alias("speech_duration"),
        _ratio(spoken, total).alias("speech_ratio"),
        F.size("speech").cast("bigint").alias("nsp06_seg_cnt"),
        F.size("words").cast("bigint").alias("nsp06_word_cnt"),
        F.size(F.array_distinct("words")).cast("bigint").alias("nsp06_unique_word_cnt"),
    )


def segment_metrics_long(segments: DataFrame, tracks: DataFrame | None = None) -> DataFrame:
    """The same metrics from one row per segment.

    ``segments`` has track_id, seg_no, start_s, end_s, text, no_speech_prob.
    ``tracks`` (track_id, text) gives the whole texts and names tracks that have
    no segment; without it the text length is that of the segments put together.

    Each segment is read once and becomes one row of its numbers and one row per word. No track's
    words are brought together in one place: rows are summed up per (track, word), on the map side
    first, the numbers under no word, and only those sums meet on the track id, again summed up before
    they shuffle.
    """
    speech = _is_speech(F.col("no_speech_prob"))
    seconds = F.col("end_s") - F.col("start_s")
    numbers = {
        "word": F.lit(None).cast("string"),
        "seg_no": F.col("seg_no"),
        "end_s": F.col("end_s"),
        "chars": F.length("text").cast("bigint"),
        "spoken": F.when(speech, seconds),
        "segs": F.lit(1).cast("bigint"),
        "kept": F.when(speech, 1).cast("bigint"),
        "times": F.lit(None).cast("bigint"),
    }
    own = F.struct(*[c.alias(n) for n, c in numbers.items()])
    none = {n: F.when(F.lit(False), c) for n, c in numbers.items()}
    words = F.coalesce(F.when(speech, tokens(F.col("text"))), F.array().cast("array<string>"))
    each = F.transform(
        words,
        lambda w: F.struct(*[c.alias(n) for n, c in (none | {"word": w, "times": F.lit(1).cast("bigint")}).items()]),
    )
    sums = [F.sum(c).alias(c) for c in ("chars", "segs", "spoken", "kept", "times")]
    last = [F.max_by("end_s", "seg_no").alias("end_s"), F.max("seg_no").alias("seg_no")]
    counted = (
        segments.select("track_id", F.inline(F.concat(F.array(own), each)))
        .groupBy("track_id", "word")
        .agg(*sums, *last)
    )
    grouped = counted.groupBy("track_id").agg(
        F.sum("chars").alias("chars"),
        F.sum("segs").alias("all_seg_cnt"),
        F.max_by("end_s", "seg_no").alias("last_end"),
        F.sum("spoken").alias("spoken"),
        F.sum("kept").alias("nsp06_seg_cnt"),
        F.sum("times").alias("nsp06_word_cnt"),
        F.count("word").alias("nsp06_unique_word_cnt"),
    )
    if tracks is not None:
        # Both sides have one row per track here.
        texts = tracks.select("track_id", F.length("text").alias("text_chars"))
        grouped = texts.join(grouped, "track_id", "left").withColumn(
            "chars", F.col("text_chars")
        )

    def known(name: str, kind: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast(kind)

    duration = known("last_end", "double")
    seconds = known("spoken", "double")
    return grouped.select(
        "track_id",
        known("chars", "bigint").alias("text_length"),
        known("all_seg_cnt", "bigint").alias("all_seg_cnt"),
        duration.alias("total_duration"),
        seconds.alias("speech_duration"),
        _ratio(seconds, duration).alias("speech_ratio"),
        *[known(c, "bigint").alias(c) for c in METRIC_COLUMNS[6:]],
    )
