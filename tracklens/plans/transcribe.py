"""Scoring that keeps what it has finished."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklens.operators.scoring import Scorer, score_batches
from tracklens.plans.ledger import Ledger


def score_in_waves(
    df: DataFrame,
    make_scorer: Callable[[], Scorer],
    schema: T.StructType | str,
    folder: str,
    key: str = "track_id",
    waves: int = 16,
    partitions: int | None = None,
) -> DataFrame:
    """``score_batches``, a hash share of the keys at a time, each written below ``folder``.

    A rerun with the same folder reads the waves that were finished and scores the others only,
    so a job that dies loses one wave at most. Every wave reads ``df``, which should be cheap
    beside the scoring; ``partitions`` deals each wave out anew. Waves are jobs one after another: have
    few enough that each fills the cluster.
    """
    spark = df.sparkSession
    folder = f"{folder.rstrip('/')}/{waves}-waves"
    ledger = Ledger(spark, f"{folder}/steps")
    share = F.pmod(F.xxhash64(F.col(key)), F.lit(waves))
    paths = []
    for wave in range(waves):
        scored = score_batches(df.where(share == wave), make_scorer, schema, key, partitions)
        paths.append(f"{folder}/wave-{wave:05d}")
        if ledger.counts(f"wave-{wave:05d}") is None:
            scored.write.mode("overwrite").parquet(paths[-1])
            ledger.finish(f"wave-{wave:05d}")
    return spark.read.schema(scored.schema).parquet(*paths)
