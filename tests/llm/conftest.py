import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

SOME = "the quick brown fox jumps over the lazy dog and then it runs away from all of them at once today"

# Nulls in any column, empty and long texts, ties, repeated rows.
ROWS = [
    (1, SOME, "en", "a", 1), (2, SOME, "en", "a", None), (2, SOME, "en", "a", None),
    (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \t\n\x0b\x0c\r ", "en", "b", 7),
    (6, "héllo wörld, this is a longer line\nhéllo wörld, this is a longer line\nshort", "fr", None, 3),
    (7, "HÉLLO  x\n  héllo wörld, This is A longer Line \nanother line of some length\n", None, "c", 3),
    (None, "another line of some length\nunseen words here " + SOME, "en", "c", 3),
    (None, None, None, "c", None),
    (8, ("long words in a very long text number {} " * 4000).format(*range(4000)), "en", "b", 9),
    (9, "x" * 50_000, "de", "b", 9), (10, "漢字 😀 " * 300, "zh", "d", 9),
    (11, "again and again " * 200, "en", "d", 9), (12, SOME.upper() + "!!", "en", "a", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small():
    return "/root/testdata/sf0.001"
