"""Helpers that the corpus operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.session import apply_runtime_options, scratch_dir

# Rows of an Arrow batch. Documents may be long, so batches are kept short.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Turn on adaptive execution and keep Arrow batches of texts small."""
    apply_runtime_options(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs no work done before it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column; null stays ``None``.

    ``bytes.split()`` and ``bytes.strip()`` then cut at exactly the ASCII
    white space x20 and x09-x0D, and ``bytes.lower()`` changes only A-Z.
    """
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def narrow(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that other names cannot clash."""
    return docs.select(*(docs[c] for c in columns))


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns named c0, c1, ..., so that none clashes with what an operator adds."""
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))


def number_of(docs: DataFrame, name: str) -> str:
    """The name of a column of ``docs`` in ``numbered(docs)``."""
    return f"c{docs.columns.index(name)}"


def remainder(id_column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; null ids give 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % modulus, F.lit(0))

