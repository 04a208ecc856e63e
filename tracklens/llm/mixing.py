"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is wanted target / size times. The whole copies are
certain; the fractions are settled in pairs: one of two documents gives words to
the other until a fraction is 0 or 1, in a direction drawn so that expected
copies do not change. The words wanted from a pair stay the same at each step, so
a source misses its target by at most one document. Buckets of a source are
settled apart from each other and leave one fraction each; a reduction tree
settles those.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklens.llm.common import column_of, narrow, number_of, numbered, prepare, raw_texts, stored

BUCKET_ROWS = 2_000
TREE_FANOUT = 64


def _word_counts(text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(raw.split()) if raw else 0 for raw in raw_texts(column_of(batch, text))]
            columns = [column_of(batch, n) for n in names] + [pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "size"])

    return run


def _ranked(sources: DataFrame) -> DataFrame:
    """Number the sources from 0 by code point, null last, without one sorting task."""
    order = [F.col("source").isNull(), F.col("source")]
    parts = stored(
        sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-sources"
    )
    before, offsets = 0, []
    for row in sorted(parts.groupBy("part").count().collect(), key=lambda r: r["part"]):
        offsets.append((row["part"], before))
        before += row["count"]
    starts = parts.sparkSession.createDataFrame(offsets, "part int, start long")
    number = F.row_number().over(W.partitionBy("part").orderBy(*order)) - 1
    numbered = parts.withColumn("rank", number).join(starts, "part")
    return numbered.withColumn("rank", F.col("rank") + F.col("start")).drop("part", "start")


def source_targets(
    sources: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3, share: float = 1
) -> DataFrame:
    """Add ``target`` to a table of ``source`` and ``source_size``.

    Sources by code point, null last, weigh ``weights`` in turn. Targets share
    ``share`` of all sizes by weight and stop at ``most`` times the source's
    size; the excess is shared again by weight until no target is above.
    Only sums reach the driver.
    """
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    ranked = _ranked(sources).withColumn(
        "weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))
    )
    ranked = stored(ranked.withColumn("most", F.col("source_size") * float(most)), "mix-ranked")
    total = (ranked.agg(F.sum("source_size").alias("s")).first()["s"] or 0) * share
    level = 0.0
    while True:
        # The level only rises, so a source once at its limit stays there.
        full = F.col("weight") * level >= F.col("most")
        row = ranked.agg(
            F.sum(F.when(full & F.lit(level > 0), F.col("most")).otherwise(0.0)).alias("full"),
            F.sum(F.when(full & F.lit(level > 0), 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not row["open"]:
            break
        raised = max(level, (total - row["full"]) / row["open"])
        if raised <= level * (1 + 1e-15):
            break
        level = raised
    target = F.least(F.col("weight") * level, F.col("most"))
    return ranked.withColumn("target", target).drop("most", "rank")


def _uniform(*parts) -> float:
    """A number in [0, 1) that depends on its arguments alone."""
    return (xxhash.xxh3_64_intdigest("|".join(map(str, parts))) >> 11) / (1 << 53)


def pivot(items: list[tuple], level: int) -> tuple[list[tuple], tuple | None]:
    """Settle ``(key, words, p)`` in pairs; at most one keeps a fraction.

    Returns the settled ``(key, taken)`` and what is left.
    """
    settled, held = [], None
    for key, words, p in items:
        if p <= 0 or p >= 1:
            settled.append((key, p >= 1))
            continue
        if held is None:
            held = (key, words, p)
            continue
        other, w, q = held
        up = min(1 - q, p * words / w)
        down = min(q, (1 - p) * words / w)
        if _uniform(other, key, level) * (up + down) < down:
            full = 1 - q <= p * words / w
            q, p = (1.0, max(0.0, p - (1 - q) * w / words)) if full else (q + p * words / w, 0.0)
        else:
            full = q <= (1 - p) * words / w
            q, p = (0.0, min(1.0, p + q * w / words)) if full else (q - (1 - p) * words / w, 1.0)
        held = None
        for item in ((other, w, q), (key, words, p)):
            if 1e-12 < item[2] < 1 - 1e-12:
                held = item
            else:
                settled.append((item[0], item[2] > 0.5))
    return settled, held


_STATE = "source string, bucket long, doc long, hash long, words long, p double, up boolean"


def _settle(level: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        source, bucket = rows[0]["source"], rows[0]["bucket"]
        rows.sort(key=lambda r: (r["doc"] is None, r["doc"] or 0, r["hash"]))
        byte = {(r["doc"], r["hash"]): r for r in rows}
        settled, held = pivot([((r["doc"], r["hash"]), r["words"], r["p"]) for r in rows], level)
        out = [byte[k] | {"up": up} for k, up in settled]
        if held:
            out.append(byte[held[0]] | {"p": held[2], "up": None})
        names = ["source", "bucket", "doc", "hash", "words", "p", "up"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_()]
        for r in out:
            r |= {"source": source, "bucket": bucket}
        return pa.table(
            [pa.array([r[n] for r in out], k) for n, k in zip(names, kinds, strict=True)], names=names
        )

    return run


def plan_copies(
    docs: DataFrame,
    id_name: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = (1, 2, 3),
    most: float = 3,
    share: float = 1,
) -> DataFrame:
    """One row per document: ``doc, source, hash, n_rows, size, source_size, target, copies``.

    ``hash`` is the text's; rows equal in id, source and text are one item that
    counts ``n_rows`` times and has one decision. Null ids, texts and sources are
    values like any other; a null or empty text has size 0, takes no words and its
    copies are rounded by themselves. An empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    slim = docs.select(
        docs[id_name].cast("long").alias("doc"), docs[source].cast("string").alias("source"),
        F.xxhash64(docs[text]).alias("hash"), docs[text].alias("text"),
    )
    sized = slim.mapInArrow(
        _word_counts("text", ["doc", "source", "hash"]), "doc long, source string, hash long, size long"
    )
    items = stored(
        sized.groupBy("doc", "source", "hash").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n_rows")),
        "mix-items",
    )
    words = F.col("size") * F.col("n_rows")
    sources = items.groupBy("source").agg(
        F.sum(words).alias("source_size"), F.count(F.lit(1)).alias("n_items")
    )
    targets = stored(source_targets(sources, weights, most, share), "mix-targets")
    wanted = items.withColumnRenamed("source", "src").join(
        targets, F.col("src").eqNullSafe(F.col("source"))
    ).drop("src")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(times)
    wanted = stored(
        wanted.withColumn("whole", whole.cast("long")).withColumn("p", times - whole), "mix-wanted"
    )
    buckets = F.ceil(F.col("n_items") / BUCKET_ROWS)
    state = wanted.where("size > 0 and p > 0").select(
        "source", F.pmod(F.xxhash64("doc", "hash"), buckets).alias("bucket"),
        "doc", "hash", words.alias("words"), "p", F.lit(None).cast("boolean").alias("up"),
    )
    done: list[DataFrame] = []
    width = targets.agg(F.max(buckets).alias("n")).first()["n"] or 0
    level = 0
    while width:
        state = stored(
            state.groupBy("source", "bucket").applyInArrow(_settle(level), _STATE), "mix-level"
        )
        done.append(state.where("up is not null"))
        state = state.where("up is null")
        if width == 1:
            break
        width = -(-width // TREE_FANOUT)
        state = state.withColumn("bucket", F.floor(F.col("bucket") / TREE_FANOUT))
        level += 1
    # What is left of a whole source is one fraction: round it by a draw of its own.
    draw = (F.pmod(F.xxhash64("doc", "hash", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)) < F.col("p")
    ups = state.withColumn("up", draw)
    for part in done:
        ups = ups.unionByName(part)
    ups = ups.where("up").select(
        F.col("doc").alias("d"), F.col("source").alias("s"), F.col("hash").alias("h"), "up"
    )
    match = (
        F.col("doc").eqNullSafe(F.col("d")) & F.col("source").eqNullSafe(F.col("s"))
        & (F.col("hash") == F.col("h"))
    )
    empty = F.when((F.col("size") == 0) & (F.col("p") > 0), draw).otherwise(F.lit(False))
    extra = F.coalesce(F.col("up"), empty).cast("long")
    return wanted.join(ups, match, "left").select(
        "doc", "source", "hash", "n_rows", "size", "source_size", "target",
        (F.col("whole") + extra).alias("copies"),
    )


def mix_sources(docs: DataFrame, id_name: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; columns stay the same.

    Rules for nulls, repeats, very long texts (counted whole) and empty input: :func:`plan_copies`. Columns
    may have any names.
    """
    plan = plan_copies(docs, id_name, text, source, **how).where("copies > 0").select(
        F.col("doc").alias("d"), F.col("source").alias("s"), F.col("hash").alias("h"), "copies"
    )
    rows, (doc, words, kind) = numbered(docs), (number_of(docs, n) for n in (id_name, text, source))
    match = (
        F.col(doc).cast("long").eqNullSafe(F.col("d"))
        & F.col(kind).cast("string").eqNullSafe(F.col("s"))
        & (F.xxhash64(words) == F.col("h"))
    )
    joined = rows.join(plan, match)
    again = joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return again.select(*rows.columns).toDF(*docs.columns)
