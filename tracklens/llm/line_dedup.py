"""Line deduplication with levelled sorted runs of line hashes.

Documents come in batches of rising ids. Each batch takes its distinct line
keys, merge-anti-joins them with the runs of earlier batches, drops what is
there already or belongs to a smaller document of the batch, and adds a sorted
run of its own new keys. When a level holds ``fanout`` runs they are compacted
into one run of the next level, so a batch meets few runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklens.llm.common import (
    column_of,
    narrow,
    number_of,
    numbered,
    prepare,
    raw_texts,
    stored,
)

MIN_POINTS = 10


def line_key(line: bytes, least: int) -> bytes | None:
    """16 bytes for a line that takes part, else ``None``."""
    key = line.strip().lower()
    if len(key) < least or (len(key) < 4 * least and len(key.decode(errors="replace")) < least):
        return None
    return xxhash.xxh3_128_digest(key)


def _keys(id_name: str, text: str, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, high, low = [], [], []
            column = column_of(batch, id_name).to_pylist()
            for doc, raw in zip(column, raw_texts(column_of(batch, text)), strict=True):
                found = {line_key(x, least) for x in (raw or b"").split(b"\n")} - {None}
                for key in found:
                    ids.append(doc)
                    high.append(int.from_bytes(key[:8], "big", signed=True))
                    low.append(int.from_bytes(key[8:], "big", signed=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64())],
                names=["doc", "k1", "k2"],
            )

    return run


def _apply(text: str, least: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, lines, dropped = [], [], []
            gone = column_of(batch, "gone").to_pylist()
            for raw, keys in zip(raw_texts(column_of(batch, text)), gone, strict=True):
                parts = (raw or b"").split(b"\n")
                lines.append(len(parts))
                if keys:
                    lost = {
                        k["k1"].to_bytes(8, "big", signed=True) + k["k2"].to_bytes(8, "big", signed=True)
                        for k in keys
                    }
                    parts = [x for x in parts if line_key(x, least) not in lost]
                    raw = b"\n".join(parts)
                kept.append(raw)
                dropped.append(lines[-1] - len(parts))
            made = {
                text: pa.array(kept, pa.binary()).cast(pa.string()),
                "n_lines": pa.array(lines, pa.int64()),
                "n_dropped": pa.array(dropped, pa.int64()),
            }
            yield pa.RecordBatch.from_arrays(
                [made[n] if n in made else column_of(batch, n) for n in names], names=names
            )

    return run


def _bounds(docs: DataFrame, id_name: str, batches: int) -> list[int]:
    """Ids that cut the documents into about equal batches."""
    shares = [i / batches for i in range(1, batches)]
    row = docs.agg(F.percentile_approx(id_name, shares, 1000).alias("q")).first()
    return sorted(set(row["q"] or []))


def dropped_keys(
    docs: DataFrame,
    id_name: str = "doc_id",
    text: str = "text",
    least: int = MIN_POINTS,
    batches: int = 4,
    fanout: int = 2,
) -> DataFrame:
    """``(doc, k1, k2)``: the line keys that each document loses."""
    spark = prepare(docs.sparkSession)
    bounds = _bounds(narrow(docs, id_name), id_name, batches)
    schema = "doc long, k1 long, k2 long"
    lines = narrow(docs, id_name, text).mapInArrow(_keys(id_name, text, least), schema)
    # A null id counts as one document after all others.
    place = F.when(F.col("doc").isNull(), F.lit(len(bounds)))
    for i, bound in enumerate(bounds):
        place = place.when(F.col("doc") <= bound, F.lit(i))
    lines = stored(lines.withColumn("batch", place.otherwise(F.lit(len(bounds)))), "line-keys")
    order = F.struct(F.col("doc").isNull().alias("last"), F.col("doc"))
    levels: list[list[DataFrame]] = []
    lost: list[DataFrame] = []
    for i in range(len(bounds) + 1):
        batch = lines.where(F.col("batch") == i).drop("batch")
        mine = batch.groupBy("k1", "k2").agg(
            F.min(order).alias("first"), F.max(order).alias("final")
        )
        runs = [r for level in levels for r in level]
        if runs:
            seen = runs[0]
            for r in runs[1:]:
                seen = seen.unionByName(r)
            seen = seen.withColumn("old", F.lit(True))
            mine = mine.join(seen.hint("merge"), ["k1", "k2"], "left")
        else:
            mine = mine.withColumn("old", F.lit(None).cast("boolean"))
        mine = stored(mine, "line-batch")
        repeated = mine.where("old or first <> final").select(
            "k1", "k2", F.col("old").isNotNull().alias("old"), F.col("first.doc").alias("owner")
        )
        lost.append(
            batch.join(repeated, ["k1", "k2"])
            .where(F.col("old") | ~F.col("doc").eqNullSafe(F.col("owner")))
            .select("doc", "k1", "k2")
        )
        fresh = mine.where("old is null").select("k1", "k2")
        _add_run(levels, stored(fresh.sortWithinPartitions("k1", "k2"), "line-run"), fanout)
    out = lost[0]
    for more in lost[1:]:
        out = out.unionByName(more)
    return out


def _add_run(levels: list[list[DataFrame]], run: DataFrame, fanout: int) -> None:
    """Put a run on level 0; a full level becomes one run of the next."""
    level = 0
    while True:
        if len(levels) == level:
            levels.append([])
        levels[level].append(run)
        if len(levels[level]) < fanout:
            return
        merged = levels[level][0]
        for other in levels[level][1:]:
            merged = merged.unionByName(other)
        parts = merged.repartition("k1", "k2").sortWithinPartitions("k1", "k2")
        run, levels[level], level = stored(parts, "line-run"), [], level + 1


def dedup_lines(
    docs: DataFrame,
    id_name: str = "doc_id",
    text: str = "text",
    least: int = MIN_POINTS,
    batches: int = 4,
    fanout: int = 2,
) -> DataFrame:
    """``docs`` without repeated lines, plus ``n_lines`` and ``n_dropped``.

    A line's key is the line without white space (x20, x09-x0D) at both ends and
    with A-Z in lower case. A key of at least ``least`` code points that occurs
    in two or more documents stays, with all its lines, only in the document
    with the smallest id. Null and empty texts are one empty line and stay as
    they are. Rows with the same id are one document, each row keeps or loses
    the same keys; rows with a null id are one document after all others.
    Other columns pass through under any names; input columns
    named ``n_lines`` or ``n_dropped`` are replaced. An empty table gives no rows.
    """
    lost = dropped_keys(docs, id_name, text, least, batches, fanout)
    gone = lost.groupBy("doc").agg(F.collect_set(F.struct("k1", "k2")).alias("gone"))
    base = docs.drop("n_lines", "n_dropped")
    rows = numbered(base)
    joined = rows.join(gone, F.col("doc").eqNullSafe(F.col(number_of(base, id_name))), "left").drop("doc")
    made = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    schema = T.StructType(rows.schema.fields + made)
    kept = joined.mapInArrow(_apply(number_of(base, text), least, schema.fieldNames()), schema)
    return kept.toDF(*base.columns, "n_lines", "n_dropped")
