"""Explicit schemas: nothing in the library infers one."""

from pyspark.sql import types as T

from tracklens.constants import DOUBLE_METRICS, METRIC_COLUMNS


def _metric_fields(key: str) -> list[T.StructField]:
    names = [key] + METRIC_COLUMNS[1:]
    return [
        T.StructField(n, T.DoubleType() if n in DOUBLE_METRICS else T.LongType())
        for n in names
    ]


METRICS_SCHEMA = T.StructType(_metric_fields("track_id"))
METRICS_SRC_SCHEMA = T.StructType(_metric_fields("track_id_src"))

SEGMENT_TYPE = T.StructType(
    [
        T.StructField("start", T.DoubleType()),
        T.StructField("end", T.DoubleType()),
        T.StructField("text", T.StringType()),
        T.StructField("no_speech_prob", T.DoubleType()),
    ]
)
TRANSCRIPT_SCHEMA = T.StructType(
    [
        T.StructField("track_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("segments", T.ArrayType(SEGMENT_TYPE)),
    ]
)
