"""A corpus from raw documents to tokens, in five stages over the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracklens.llm import line_dedup, mixing, sentencepiece_fst, simhash, toxicity
from tracklens.llm.common import stored
from tracklens.llm.queries import MODEL_PATH


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; learned from the labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = toxicity.train(docs, toxicity.learning_rows(labels, "doc_id", 5, 0))
    return toxicity.drop_toxic(docs, weights)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines stay only in the first document that holds them; all documents stay."""
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.keep_one(docs, width=4, radius=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix_sources(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their pieces."""
    return sentencepiece_fst.encode(docs, MODEL_PATH)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_copies),
    ("mixing", mix),
    ("sentencepiece", tokenize),
]

# Learned weights, fingerprints, draws and merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
