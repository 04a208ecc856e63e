"""Document fingerprints as threshold-scaled sketches.

A sketch keeps every shingle hash of a text below a fixed fraction of the range of hashes, so
the sketches of a short note and of a long book keep the same hashes of what they share: how
much of the note the book contains is estimated without bias however unequal they are, and the
sketch of many texts together is the union of theirs. Besides those, the ``floor`` smallest hashes
are kept whatever their size; a text with few shingles is then compared exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklens.llm.common import column_of, narrow, prepare, stored

WIDTH = 5
FRACTION = 1 / 16
FLOOR = 16
SEED = 42
_TOP = 1 << 63
_MIX = 0x9E3779B97F4A7C15
_ODD = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def shingle_hashes(raw: bytes, width: int = WIDTH) -> np.ndarray:
    """63-bit hashes of a text's word shingles in lower case (A-Z); few words are one shingle."""
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    x = np.fromiter((digest(w, SEED) for w in words), np.uint64, len(words))
    width = min(width, len(x))
    n = len(x) - width + 1
    # A polynomial of the words' hashes, mixed so that all bits depend on all words.
    factors = list(accumulate([_MIX] * width, lambda a, b: a * b % (1 << 64)))
    total = np.zeros(n, np.uint64)
    for k, factor in enumerate(factors):
        total += x[k : k + n] * np.uint64(factor)
    for shift, odd in zip((30, 27), _ODD, strict=True):
        total = (total ^ (total >> np.uint64(shift))) * np.uint64(odd)
    return (total ^ (total >> np.uint64(31))) >> np.uint64(1)


def sketch(raw: bytes | None, width: int = WIDTH, fraction: float = FRACTION, floor: int = FLOOR) -> np.ndarray:
    """The sorted distinct hashes below the fraction, and the ``floor`` smallest in any case."""
    found = np.unique(shingle_hashes(raw or b"", width))
    below = int(np.searchsorted(found, np.uint64(fraction * _TOP)))
    return found[: max(below, floor)]


def _known(x: np.ndarray, fraction: float, floor: int) -> int:
    """All hashes of the text that are no larger than this are in its sketch."""
    limit = int(fraction * _TOP) - 1
    if len(x) < floor:
        return _TOP
    return max(limit, int(x[-1])) if len(x) <= floor else limit


def likeness(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION, floor: int = FLOOR) -> tuple[float, float]:
    """Estimates from two sketches: how much of a's text is in b's, and their resemblance.

    Two texts without shingles are alike (1). Where the range known of both holds no hash of ``a``
    the containment is 0 unless the sketches are equal.
    """
    if len(a) == len(b) and (a == b).all():
        return 1.0, 1.0
    limit = np.uint64(min(_known(a, fraction, floor), _known(b, fraction, floor)))
    a = a[: np.searchsorted(a, limit, "right")]
    b = b[: np.searchsorted(b, limit, "right")]
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / max(1, len(a)), shared / max(1, len(a) + len(b) - shared)


def _packed(x: np.ndarray) -> bytes:
    return x.astype(">u8").tobytes()


def _unpacked(raw: bytes | None) -> np.ndarray:
    return np.frombuffer(raw or b"", ">u8").astype(np.uint64)


def sketches(
    docs: DataFrame, id_name: str = "doc_id", text: str = "text",
    width: int = WIDTH, fraction: float = FRACTION, floor: int = FLOOR,
) -> DataFrame:
    """``(id, sketch)`` for every row: its hashes, ascending, eight bytes each. No shuffle.

    Null and empty texts, and texts of white space, have an empty sketch. Other columns are not
    looked at; repeated rows stay.
    """
    prepare(docs.sparkSession)
    slim = narrow(docs, id_name, text)
    schema = T.StructType([slim.schema[id_name], T.StructField("sketch", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_packed(sketch(None if t is None else t.encode(), width, fraction, floor)) for t in column_of(batch, text).to_pylist()]
            yield pa.RecordBatch.from_arrays([column_of(batch, id_name), pa.array(made, pa.binary())], names=schema.fieldNames())

    return slim.mapInArrow(run, schema)


def merged(found: DataFrame, key: str, fraction: float = FRACTION, floor: int = FLOOR) -> DataFrame:
    """``(key, hash)``: the sketch of all texts of each ``key`` together, a row per hash.

    ``found`` has ``key`` and ``sketch``. It equals the sketch of one text with all their shingles. Hashes
    are made distinct on (key, hash), so no task holds a whole key, however many texts it has.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_unpacked(raw) for raw in column_of(batch, "sketch").to_pylist()]
            rows = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            hashes = np.concatenate([*parts, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([column_of(batch, key).take(pa.array(rows)), pa.array(hashes)], names=[key, "hash"])

    schema = T.StructType([found.schema[key], T.StructField("hash", T.LongType())])
    rows = stored(narrow(found, key, "sketch").mapInArrow(run, schema).distinct(), "sketch-hashes")
    low = F.col("hash") < int(fraction * _TOP)
    counts = rows.groupBy(key).agg(F.count_if(low).alias("low")).where(F.col("low") < floor)
    # Few keys need hashes beyond the fraction; those have few below it, and not many beyond.
    few = rows.where(~low).join(counts.withColumnRenamed(key, "few"), F.col(key).eqNullSafe(F.col("few")))
    place = F.row_number().over(W.partitionBy(key).orderBy("hash"))
    rest = few.withColumn("place", place).where(F.col("place") + F.col("low") <= floor)
    return rows.where(low).unionByName(rest.select(key, "hash"))


def _edited(text: str, after: str) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of ``after``."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + after[:quarter]


class _Follower:
    """Rows of one partition in order: each is finished when the next one is known."""

    NAMES = ("doc", "n_chars", "edited_sha256", "sketch", "edited_sketch",
             "near_edited", "near_next", "alike_edited", "alike_next", "open", "head", "part")
    KINDS = (pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(),
             *[pa.float64()] * 4, pa.string(), pa.string(), pa.int32())

    def __init__(self, width: int, fraction: float, floor: int):
        self.how = (width, fraction, floor)

    def sketch(self, text: str) -> np.ndarray:
        return sketch(text.encode(), *self.how)

    def finished(self, doc, text: str, mine: np.ndarray, after: str, theirs: np.ndarray) -> tuple:
        changed = _edited(text, after)
        other = self.sketch(changed)
        contained, alike = zip(likeness(mine, other, *self.how[1:]), likeness(mine, theirs, *self.how[1:]), strict=True)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        return doc, len(text), digest, _packed(mine), _packed(other), *contained, *alike, None, None, None

    def batch(self, rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(self.NAMES)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, self.KINDS, strict=True)], names=list(self.NAMES))

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            rows = []
            docs, texts, part = (column_of(batch, n) for n in ("doc", "text", "part"))
            # One text at a time becomes a Python string; the batch's stay in Arrow.
            for i in range(batch.num_rows):
                doc, text, at = docs[i].as_py(), texts[i].as_py(), part[i].as_py()
                mine = self.sketch(text)
                if last is None:
                    rows.append((None,) * 10 + (text, at))
                else:
                    rows.append(self.finished(*last[:3], text, mine))
                last = doc, text, mine, at
            yield self.batch(rows)
        if last is not None:
            yield self.batch([(last[0], *(None,) * 8, last[1], None, last[3])])

    def close(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last rows of partitions, each with the first text of the next."""
        for batch in batches:
            docs, texts, after = (column_of(batch, n).to_pylist() for n in ("doc", "open", "after"))
            rows = [self.finished(d, t, self.sketch(t), a, self.sketch(a)) for d, t, a in zip(docs, texts, after, strict=True)]
            yield self.batch(rows)


def fingerprints(
    docs: DataFrame, id_name: str = "doc_id", text: str = "text",
    width: int = WIDTH, fraction: float = FRACTION, floor: int = FLOOR,
) -> DataFrame:
    """Each text's sketch beside that of an edited text and that of the next document.

    Returns, for every row, the id and ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``
    (16 hex digits a hash), ``near_edited`` and ``near_next`` (how much of the document the other holds),
    ``alike_edited`` and ``alike_next`` (resemblance). In the edited text the last quarter of the
    code points is replaced by as many of the beginning of the next document by id, or by all it has.

    Null ids come first; rows of one id go by their text; the first document follows the last, so a single
    one follows itself. Null texts are empty. Texts without words have an empty fingerprint, and such texts are
    alike (1). Very long texts are whole. Other columns are not looked at. An empty table gives no rows.

    One shuffle brings the rows into order by ranges of ids, two for each split of the input; counting the splits, the
    choice of ranges and the shuffle read the input each, so a costly one is best written first. A task streams over its rows and holds two texts. The
    first and last row of each partition are settled afterwards, from one row per partition.
    """
    prepare(docs.sparkSession)
    slim = docs.select(docs[id_name].cast("long").alias("doc"), F.coalesce(docs[text], F.lit("")).alias("text"))
    # Rows of one id may lie in several ranges: the hash orders them, the text settles what is left.
    rows = slim.withColumn("turn", F.xxhash64("text"))
    # Two ranges for each split of the input: a task sorts about half a split of texts.
    ranges = max(1, 2 * rows.rdd.getNumPartitions())
    placed = rows.repartitionByRange(ranges, F.col("doc").asc_nulls_first(), "turn").sortWithinPartitions(
        F.col("doc").asc_nulls_first(), "turn", "text"
    )
    follower = _Follower(width, fraction, floor)
    schema = (
        "doc long, n_chars long, edited_sha256 string, sketch binary, edited_sketch binary, near_edited double, "
        "near_next double, alike_edited double, alike_next double, open string, head string, part int"
    )
    ordered = placed.select("doc", "text", F.spark_partition_id().alias("part"))
    found = stored(ordered.mapInArrow(follower.run, schema), "sketch-rows")
    heads = stored(found.where("head is not null").select("part", F.col("head").alias("after")), "sketch-heads")
    # Partitions without rows are left out; the first one follows the last.
    turn = W.orderBy("part")
    whole = turn.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    follows = heads.select("part").select(
        "part", F.coalesce(F.lead("part").over(turn), F.first("part").over(whole)).alias("next")
    )
    ends = found.where("open is not null").select("doc", "open", "part").join(follows, "part")
    ends = ends.join(heads.withColumnRenamed("part", "next"), "next").select("doc", "open", "after")
    every = found.where("n_chars is not null").unionByName(ends.mapInArrow(follower.close, schema))
    kind = docs.schema[id_name].dataType
    return every.select(
        F.col("doc").cast(kind).alias(id_name), "n_chars", "edited_sha256",
        F.lower(F.hex("sketch")).alias("fingerprint"), F.lower(F.hex("edited_sketch")).alias("edited_fingerprint"),
        "near_edited", "near_next", "alike_edited", "alike_next",
    )
