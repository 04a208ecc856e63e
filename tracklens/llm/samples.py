"""Bounded samples of labelled rows, from which the classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklens.llm.common import stored


def labelled_sample(rows: DataFrame, id_name: str, label: str, rows_per_label: int, labels: int = 64) -> DataFrame:
    """At most ``rows_per_label`` rows of each of at most ``labels`` labels of a narrow table.

    Rows are taken in the order of a hash of the id, so a rerun takes the same ones. Each
    label's share of hashes is settled by counts first; no label is sorted as a whole. Rows
    with a null id or label are not taken.
    """
    known = rows.where(F.col(id_name).isNotNull() & F.col(label).isNotNull()).select(id_name, label)
    counts = (
        known.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), label).limit(labels).collect()
    )
    draw = F.pmod(F.xxhash64(F.col(id_name), F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    parts = []
    for row in counts:
        mine = known.where(F.col(label) == row[label])
        # A margin above the wanted share, then the exact number of what is left.
        share = min(1.0, (1.2 * rows_per_label + 50) / row["n"])
        parts.append(mine.where(draw < share).orderBy(draw, id_name).limit(rows_per_label))
    if not parts:
        return known.limit(0)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return stored(out, "sample")


def even_sample(rows: DataFrame, id_name: str, label: str, most_per_label: int, most_rows: int) -> DataFrame:
    """``(id, label)``: up to ``most_per_label`` rows of every label, fewer if there are very many labels.

    Each label gets an even share of ``most_rows``, at least one row; so all labels are there
    unless they are more than that (then the commonest are). Rows are taken in the order of a hash of
    the id; a label's rows are thinned out by it before they are ordered.
    """
    known = rows.where(F.col(id_name).isNotNull() & F.col(label).isNotNull()).select(
        F.col(id_name).alias("id"), F.col(label).alias("label")
    )
    counts = known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(most_rows)
    counts = stored(counts, "sample-labels")
    share = max(1, min(most_per_label, most_rows // max(1, counts.count())))
    draw = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    drawn = known.join(counts, "label").where(draw * F.col("n") < 1.2 * share + 50)
    place = F.row_number().over(W.partitionBy("label").orderBy(draw, "id"))
    return stored(drawn.withColumn("place", place).where(F.col("place") <= share).select("id", "label"), "sample")


def with_texts(sample: DataFrame, docs: DataFrame, id_name: str, text: str, label: str, sampled: str | None = None) -> DataFrame:
    """``(id, label, text)`` of the sampled rows; the sample is bounded, so it is broadcast.

    An id that was sampled with several labels has the smallest; a repeated id gives all its texts.
    ``sampled`` is the id's name in ``sample`` if it differs.
    """
    ids = sample.groupBy(F.col(sampled or id_name).alias("id")).agg(F.min(label).alias("label"))
    texts = docs.select(docs[id_name].alias("doc"), docs[text].alias("text"))
    return texts.join(F.broadcast(ids), F.col("doc") == F.col("id")).select("id", "label", "text")


def with_labels(labels: DataFrame, docs: DataFrame, id_name: str, text: str, label: str) -> DataFrame:
    """``(id, label, text)`` of all labelled documents; Spark chooses the join.

    Ids as in ``with_texts``: with several labels the smallest counts, a repeated id gives all its texts.
    """
    ids = labels.groupBy(F.col(id_name).alias("id")).agg(F.min(label).alias("label"))
    texts = docs.select(docs[id_name].alias("doc"), docs[text].alias("text"))
    return texts.join(ids, F.col("doc") == F.col("id")).select("id", "label", "text")
