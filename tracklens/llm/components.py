"""Connected components of an edge table, without gathering edges anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.llm.common import stored


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b") % 1_000_000_007).alias("h"),
        F.countDistinct("a").alias("d"),
    ).first()
    return row["n"], row["h"], row["d"]


def connected_components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the smallest node reachable.

    Alternates the large-star and small-star steps until the edges are a forest
    of stars. Minima are taken with map-side partials and joined back, so a
    node with very many neighbours is never gathered. Every round is a written
    table. Self-loops and null ends are ignored; an empty table gives no rows.
    """
    pair = edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).where("a is not null and b is not null and a <> b")
    current = stored(pair.distinct(), "edges")
    before = _digest(current)
    for _ in range(rounds):
        if before[0] == 0:
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(low, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(
                F.struct(F.col("a"), F.col("m").alias("b")),
                F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            )).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        current = stored(small, "edges")
        after = _digest(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
