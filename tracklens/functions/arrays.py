"""The one-minute excerpt of a long recording, by array slicing."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def excerpt_bounds(n: Column, keep: int, size: int) -> Column:
    """The sample ranges to keep, as ``array<struct<part,start_sample,end_sample>>``.

    Ranges are 0-based with an open end. A recording shorter than ``keep``
    samples is one whole range; a longer one gives ``size`` samples from each
    of its two inner third points.
    """
    n = n.cast("bigint")

    def part(no: int, start: Column, end: Column) -> Column:
        return F.struct(
            F.lit(no).alias("part"),
            start.cast("bigint").alias("start_sample"),
            end.cast("bigint").alias("end_sample"),
        )

    first = F.floor(n / 3)
    second = F.floor(n * 2 / 3)
    return F.when(n < keep, F.array(part(0, F.lit(0), n))).otherwise(
        F.array(part(0, first, first + size), part(1, second, second + size))
    )


def excerpt(samples: Column, keep: int, size: int) -> Column:
    """The samples themselves, cut at the ranges of ``excerpt_bounds``."""
    n = F.size(samples)
    first = F.floor(n / 3).cast("int") + 1
    second = F.floor(n * 2 / 3).cast("int") + 1
    return F.when(n < keep, samples).otherwise(
        F.concat(F.slice(samples, first, size), F.slice(samples, second, size))
    )
