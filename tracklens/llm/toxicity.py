"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklens.llm.common import column_of, prepare, raw_texts, remainder
from tracklens.llm.samples import labelled_sample, with_texts

SAMPLE_PER_LABEL = 2500
# The intercept where nothing tells toxic from clean: no text is called toxic.
UNLEARNED = -1.0
_EDGES = b".,;:!?\"'()[]{}|*#_-<>"
# A word counts as itself and by its beginnings of so many bytes, for inflected forms.
BEGINNINGS = (4, 5, 6, 7, 8)


class Words(dict):
    """Rows of a table of word hashes: marks at the ends go, A-Z is put into lower case."""

    MOST = 1 << 17

    def __init__(self):
        self.table = np.zeros((1 << 12, 1 + len(BEGINNINGS)), np.uint64)

    def __missing__(self, word: bytes) -> int:
        row = len(self)
        if row == len(self.table):
            self.table = np.concatenate((self.table, np.zeros_like(self.table)))
        plain = word.strip(_EDGES).lower()
        own = xxhash.xxh3_64_intdigest(plain)
        self.table[row] = own
        for k, size in enumerate(BEGINNINGS, 1):
            if len(plain) > size:
                self.table[row, k] = xxhash.xxh3_64_intdigest(plain[:size], size)
        self[word] = row
        return row


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


def features(raw: bytes | None, cache: Words) -> np.ndarray:
    """32-bit hashes of a whole text: words, beginnings, pairs, pairs with one or two words between."""
    if len(cache) > cache.MOST:
        cache.clear()
    words = (raw or b"").split()
    n = len(words)
    rows = np.fromiter(map(cache.__getitem__, words), np.int64, n)
    table = cache.table[rows]
    h = table[:, 0]
    parts = [table.ravel()]
    for gap in (1, 2, 3):
        if n > gap:
            parts.append(_mix(h[:-gap] * np.uint64(0x9E3779B97F4A7C15) + h[gap:] + np.uint64(gap)))
    return (np.concatenate(parts) >> np.uint64(32)).astype(np.uint32)


@dataclass
class Weights:
    """Sparse weights: sorted feature hashes, their weights, and the intercept.

    ``both`` is false if they were not learned from rows of both classes; their scores then
    tell no text from another, and nothing may be rejected by them.
    """

    keys: np.ndarray
    values: np.ndarray
    bias: float
    both: bool = True

    def __post_init__(self):
        self.near = np.zeros(1 << 16, bool)
        self.near[self.keys >> np.uint32(16)] = True

    def score(self, found: np.ndarray) -> float:
        """Probability for the set of a text's features."""
        total = self.bias
        if len(self.keys):
            found = found[self.near[found >> np.uint32(16)]]
            found = np.unique(found)
            at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
            total += float(self.values[at[self.keys[at] == found]].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -35, 35))))


def fit_ftrl(
    rows: list[np.ndarray],
    labels: np.ndarray,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 3.0,
    l2: float = 0.1,
    epochs: int = 3,
    seed: int = 3,
) -> Weights:
    """Per-coordinate FTRL-proximal with L1; features are sets of hashes.

    The intercept starts at the sample's log odds. Features of a single row are left out, and
    ``l1`` at the number of epochs keeps a single row from giving any feature a weight.
    """
    every = np.concatenate(rows) if rows else np.zeros(0, np.uint32)
    keys, counts = np.unique(every, return_counts=True)
    keys = keys[counts > 1]
    index = []
    for r in rows:
        at = np.searchsorted(keys, r)
        at[at == len(keys)] = 0
        index.append(at[keys[at] == r] if len(keys) else at[:0])
    z, n = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)
    positive, rest = int(labels.sum()), int((labels == 0).sum())
    prior = float(np.log((positive + 0.5) / (rest + 0.5)))
    rng = np.random.default_rng(seed)

    def solved(zi, ni):
        big = np.abs(zi) > l1
        return np.where(big, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2), 0.0)

    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at = np.append(index[i], len(keys))  # the last coordinate is the intercept
            zi, ni = z[at], n[at]
            w = solved(zi, ni)
            p = 1 / (1 + np.exp(-np.clip(prior + w.sum(), -35, 35)))
            g = p - labels[i]
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[at] = zi + g - step * w
            n[at] = ni + g * g
    w = solved(z, n)
    some = np.flatnonzero(w[:-1])
    return Weights(keys[some], w[some], prior + float(w[-1]), positive > 0 and rest > 0)


def _counts(rows: DataFrame, label: str) -> dict[int, int]:
    return {int(r[label]): r["count"] for r in rows.groupBy(label).count().collect()}


def odds_shift(every: dict[int, int], taken: dict[int, int]) -> float:
    """What to add to the log odds learned from ``taken`` rows of each class, 0 and 1, of ``every`` row.

    Zero where both classes were taken at one rate, or where one is missing.
    """
    if not all(n.get(k) for n in (every, taken) for k in (0, 1)):
        return 0.0
    return float(np.log(every[1] / every[0]) - np.log(taken[1] / taken[0]))


def _sets():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Words()
        for batch in batches:
            found = [np.unique(features(r, cache)).view(np.int32) for r in raw_texts(column_of(batch, "text"))]
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "id"), column_of(batch, "label").cast(pa.int32()), pa.array(found, pa.list_(pa.int32()))],
                names=["id", "label", "found"],
            )

    return run


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_name: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample_per_label: int = SAMPLE_PER_LABEL,
    **how,
) -> Weights:
    """Fit on at most ``sample_per_label`` labelled documents of each class, 0 and 1.

    Whole texts give the features. Where the bound takes one class at a lower rate than the other, the
    intercept is moved back to the odds of all labelled rows, so that scores mean the same at any
    size. Labels other than 0 and 1 are not used; an id labelled both counts as 0. Without rows of both
    classes all scores are the same, below one half. Documents without text may be labelled.
    """
    prepare(docs.sparkSession)
    marked = labels.select(labels[id_name], labels[label]).where(F.col(label).isin(0, 1) & F.col(id_name).isNotNull())
    sample = labelled_sample(marked, id_name, label, sample_per_label, labels=2)
    table = with_texts(sample, docs, id_name, text, label).mapInArrow(_sets(), "id long, label int, found array<int>")
    rows = table.toArrow()
    order = np.argsort(np.array(rows.column("id").to_pylist(), np.int64), kind="stable")
    found = rows.column("found").combine_chunks()
    flat, offsets = found.flatten().to_numpy().view(np.uint32), found.offsets.to_numpy()
    offsets = offsets - offsets[0] if len(offsets) else offsets
    sets = [flat[offsets[i] : offsets[i + 1]] for i in order]
    marks = np.array(rows.column("label").to_pylist(), np.int64)[order]
    weights = fit_ftrl(sets, marks, **how)
    if not weights.both:
        return Weights(weights.keys[:0], weights.values[:0], UNLEARNED, False)
    weights.bias += odds_shift(_counts(marked, label), _counts(sample, label))
    return weights


def _scored(weights, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = weights.value, Words()
        for batch in batches:
            scores = [model.score(features(r, cache)) for r in raw_texts(column_of(batch, text))]
            yield pa.RecordBatch.from_arrays(
                [*(column_of(batch, n) for n in batch.schema.names if n != "score"), pa.array(scores, pa.float64())],
                names=[*(n for n in batch.schema.names if n != "score"), "score"],
            )

    return run


def score(docs: DataFrame, weights: Weights, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` in 0 to 1, from whole texts alone; no shuffle.

    Null and empty texts have no features and get the score of the intercept. All rows
    stay, repeated ones too; other columns pass through, a column ``score`` is replaced. An empty
    table gives no rows. The weights are sparse and bounded by the sample, so they are broadcast.
    """
    spark = prepare(docs.sparkSession)
    base = docs.drop("score")
    schema = T.StructType(base.schema.fields + [T.StructField("score", T.DoubleType())])
    return base.mapInArrow(_scored(spark.sparkContext.broadcast(weights), text), schema)


def learning_rows(labels: DataFrame, id_name: str, modulus: int, held: int) -> DataFrame:
    """Labels outside the held-out fold: ``crc32(id as text) mod modulus`` other than ``held``."""
    return labels.where(remainder(id_name, modulus) != held)


def predicted(limit: float = 0.5):
    """1 where ``score`` reaches ``limit``, else 0."""
    return (F.col("score") >= limit).cast("int")


def drop_toxic(docs: DataFrame, weights: Weights, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``; columns stay the same.

    All rows stay if the weights were not learned from both classes.
    """
    if not weights.both:
        return docs
    named = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    inner = f"c{docs.columns.index(text)}"
    return score(named, weights, inner).where(F.col("score") < limit).drop("score").toDF(*docs.columns)
