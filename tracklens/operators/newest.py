"""The newest row per key without sorting the rows.

A number that rises with the order of the rows is worked out per row from its leading order columns.
One hash aggregation over (key, number) alone finds the greatest number of each key and how many rows
have it; whole rows then meet only the keys they win, in a hash join on key and number together, so the
many rows of a heavy key spread over the tasks. Rows that share the greatest number, few as a rule, are
settled by a comparison of all their columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklens.constants import DAY_COLUMN

NEWEST_FIRST = [DAY_COLUMN, "nsp06_word_cnt", "nsp06_unique_word_cnt"]

_ORDER = "__order"
# Bits of the number that the first and the second order column take.
_FIRST_BITS, _SECOND_BITS = 40, 23
# Characters of days and clock-less times, in code order; ten of them, 4 bits each, fill the first part.
_DAY_LETTERS = "-./0123456789"
_DAY_DIGITS = "23456789abcde"


def _text_number(c: Column) -> tuple[Column, Column, int]:
    """40 bits that never fall where the text rises, whether they say all about it, and what follows if not.

    Beyond the first character that no day has, all texts count as equal. A text that is longer
    than the bits tell comes after the one that they tell in full.
    """
    known = F.regexp_extract(c, r"^[-./0-9]{0,10}", 0)
    n = F.char_length(known)
    after = F.substr(c, n + 1, F.lit(1))
    other = F.when((n < 10) & (after != ""), F.when(after < "-", "1").otherwise("f")).otherwise("")
    digits = F.rpad(F.concat(F.translate(known, _DAY_LETTERS, _DAY_DIGITS), other), 10, "0")
    number = F.conv(digits, 16, 10).cast("long") + 1
    return F.coalesce(number, F.lit(0)), F.coalesce(n == F.char_length(c), F.lit(True)), (1 << _SECOND_BITS) - 1


def _whole_number(c: Column, bits: int) -> tuple[Column, Column, int]:
    """The same for whole numbers: those from -1 up to the bits are told apart, smaller ones come before -1."""
    most = (1 << bits) - 4
    number = F.least(F.greatest(c, F.lit(-1)), F.lit(most)) + 2
    return F.coalesce(number, F.lit(0)), F.coalesce((c >= -1) & (c < most), F.lit(True)), 0


def _numbered(field: T.StructField, bits: int) -> tuple[Column, Column, int] | None:
    c, kind = F.col(field.name), field.dataType
    if isinstance(kind, T.StringType) and bits >= _FIRST_BITS:
        return _text_number(c)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return _whole_number(c.cast("long"), bits)
    if isinstance(kind, T.DateType) and bits >= _FIRST_BITS:
        return _whole_number(F.unix_date(c).cast("long") + (1 << 31), bits)
    return None


def order_number(df: DataFrame, order: Sequence[str]) -> Column:
    """A long that is never smaller for a row that comes later by ``order``; NULLs come first."""
    lead = [df.schema[c] for c in order if c in df.columns][:2]
    first = _numbered(lead[0], _FIRST_BITS) if lead else None
    if first is None:
        return F.lit(0).cast("long")
    second = _numbered(lead[1], _SECOND_BITS) if len(lead) > 1 else None
    # What the first column leaves open must not be decided by the second.
    rest = F.when(first[1], second[0]).otherwise(F.lit(first[2])) if second else F.lit(0)
    return first[0] * (1 << _SECOND_BITS) + rest


def newest_keys(df: DataFrame, key: str = "track_id", order: Sequence[str] | None = None) -> DataFrame:
    """``(key, top, n_top, n_rows)``: the greatest order number, how many rows have it, and all rows."""
    number = order_number(df, order or NEWEST_FIRST).alias("top")
    counted = df.select(key, number).groupBy(key, "top").agg(F.count("*").alias("n"))
    return counted.groupBy(key).agg(
        F.max("top").alias("top"), F.max_by("n", "top").alias("n_top"), F.sum("n").alias("n_rows")
    )


def newest_rows(
    df: DataFrame,
    keys: DataFrame,
    key: str = "track_id",
    order: Sequence[str] | None = None,
    in_place: bool = False,
) -> DataFrame:
    """The newest row of each of ``keys``, some rows of ``newest_keys``; columns stay the same.

    Among rows of one order number the greatest by ``order``, then by all columns, stays. With ``in_place``
    the rows are joined on the key alone: those of a table in buckets by it stay where they are, and
    so does a heavy key; NULL keys fall out then.
    """
    order = order or NEWEST_FIRST
    numbered = df.withColumn(_ORDER, order_number(df, order))
    wanted = keys.select(F.col(key).alias("__key"), F.col("top").alias("__top"), F.col("n_top").alias("__n"))
    if in_place:
        # A difference is no equality that rows could be dealt out by.
        on = (F.col(key) == F.col("__key")) & (F.col(_ORDER) - F.col("__top") == 0)
    else:
        on = F.col(key).eqNullSafe(F.col("__key")) & (F.col(_ORDER) == F.col("__top"))

    def reached(some: Column) -> DataFrame:
        return numbered.join(wanted.where(some).hint("shuffle_hash"), on).select(*df.columns)

    lead = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in lead and c != key]
    first = W.partitionBy(key).orderBy(F.struct(*lead, *rest).desc())
    settled = reached(F.col("__n") > 1).withColumn(_ORDER, F.row_number().over(first)).where(f"{_ORDER} = 1")
    return reached(F.col("__n") == 1).unionByName(settled.drop(_ORDER))
