"""Document quality by Bradley-Terry ranking from preference pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklens.llm.common import column_of, prepare, raw_texts, stored
from tracklens.llm.quality_rules import MEASURES, measure
from tracklens.llm.samples import with_labels

LIMIT = 0.3
# Standard deviations from the mean at which a feature is cut off.
MOST_SPREADS = 8
# Strengths are told apart by so much while weights are learned, and by so many steps for the threshold.
STEP = 1 / 32
FINE = 1 << 16
# Loss that a round has to save.
ENOUGH = 1e-6
_SHARES = 16
_DIGITS = list(b"0123456789")
_PUNCTUATION = list(b".,;:'\"()-")

Strength = Callable[[np.ndarray], np.ndarray]
# Features and labels of some rows to a vector that can be added up.
Total = Callable[[np.ndarray, np.ndarray], np.ndarray]


def measures(raw: bytes | None) -> np.ndarray:
    """Shares, lengths and the number of words of a whole text, from which ``expand`` makes its features."""
    raw = raw or b""
    m = dict(zip(MEASURES, measure(raw), strict=True))
    words = raw.split()
    n = max(1, m["n_words"])
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = max(1, m["n_upper"] + m["n_lower"])
    chars = max(1, m["word_chars"])
    lines = max(1, m["n_lines"])
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return np.array([
        min(1.0, m["n_symbols"] / n), m["n_dup_lines"] / lines, m["n_repeat_words"] / n,
        m["n_upper"] / letters, min(1.0, m["n_marks"] / n), m["n_letter_words"] / n,
        len(set(words)) / n, counts[_DIGITS].sum() / chars, counts[_PUNCTUATION].sum() / chars,
        min(1.0, counts[ord("|")] / n), min(1.0, counts[ord("@")] / n),
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        counts[128:].sum() / chars, (lengths <= 2).mean() if len(words) else 0.0,
        (lengths >= 12).mean() if len(words) else 0.0,
        sum(x[-1:] in (b".", b"!", b"?") for x in words) / n,
        np.log1p(m["n_words"]) / 10, np.log1p(m["n_lines"]) / 10, min(2.0, chars / n / 10),
        min(2.0, np.log1p(n / lines) / 5), m["n_words"],
    ], np.float64)


def expand(found: np.ndarray) -> np.ndarray:
    """The features of each row of ``measures``: shares and lengths, the shares also past some steps."""
    shares, sizes, n_words = found[:, :_SHARES], found[:, _SHARES:-1], found[:, -1:]
    steps = [shares > s for s in (0.005, 0.02, 0.08, 0.25, 0.6)]
    return np.concatenate([shares, np.sqrt(shares), sizes, *steps, n_words < (3, 10, 20, 40, 80)], axis=1)


@dataclass
class Ranker:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    # Scores at even steps of rank among the labelled rows, and the rank that becomes LIMIT.
    knots: np.ndarray = field(default_factory=lambda: np.zeros(2))
    cut: float = LIMIT

    def strength(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x) @ self.weights

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """The features as they are learned and scored: a rare one counts for no more than ``MOST_SPREADS``."""
        return np.clip((x - self.mean) / self.spread, -MOST_SPREADS, MOST_SPREADS)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Rank of the strength among the labelled rows, bent so that rank ``cut`` is LIMIT."""
        s = self.strength(x)
        ranks = np.linspace(0, 1, len(self.knots))
        rank = np.interp(s, self.knots, ranks)
        low = LIMIT * rank / max(self.cut, 1e-9)
        high = LIMIT + (1 - LIMIT) * (rank - self.cut) / max(1 - self.cut, 1e-9)
        return np.clip(np.where(rank < self.cut, low, high), 0, 1)


class Arrays:
    """Rows in memory, as ``fit`` asks for them."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.x, self.y = x, y

    def total(self, of: Total) -> np.ndarray:
        return of(self.x, self.y)

    def counts(self, of: Strength, step: float) -> tuple[np.ndarray, np.ndarray]:
        return _counts(of(self.x), self.y, step)


class Rows:
    """``(label, measures)`` rows of a table; tasks add them up, the driver sees sums of a fixed size."""

    def __init__(self, table: DataFrame):
        self.table = table

    def total(self, of: Total) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = None
            for x, y in map(_arrays, batches):
                sums = of(x, y) if sums is None else sums + of(x, y)
            if sums is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums, pa.float64())], names=["i", "v"]
                )

        parts = self.table.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
        return parts.toArrow().sort_by("i").column("v").to_numpy()

    def counts(self, of: Strength, step: float) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x, y in map(_arrays, batches):
                at, n = _counts(of(x), y, step)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (at, *n)], names=["i", "bad", "good"])

        parts = self.table.mapInArrow(run, "i long, bad double, good double").groupBy("i")
        got = parts.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toArrow().sort_by("i")
        return got.column("i").to_numpy(), np.array([got.column(c).to_numpy() for c in ("bad", "good")])


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    y = column_of(batch, "label").to_numpy(zero_copy_only=False)
    return expand(_matrix(column_of(batch, "measures"))), y


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _counts(s: np.ndarray, y: np.ndarray, step: float) -> tuple[np.ndarray, np.ndarray]:
    """Steps met by the strengths ``s``, and the rows of both classes there.

    A row counts for the steps below and above it by how near it is, so that what is linear between
    steps keeps its sum.
    """
    low = np.floor(s / step)
    above = s / step - low
    at, where = np.unique(np.concatenate([low, low + 1]).astype(np.int64), return_inverse=True)
    share = np.concatenate([1 - above, above])
    both = np.concatenate([y, y])
    return at, np.array([np.bincount(where, share * (both == k), len(at)) for k in (0, 1)])


@dataclass
class _Odds:
    """What a row of each strength meets in the other class: chances to lose, their slopes, the mean loss."""

    at: np.ndarray
    chance: np.ndarray
    slope: np.ndarray
    loss: float

    @classmethod
    def of(cls, at: np.ndarray, n: np.ndarray, pairs: int) -> _Odds:
        share = n / n.sum(axis=1, keepdims=True)
        chance, slope, loss = np.zeros((2, len(at))), np.zeros((2, len(at))), 0.0
        rows = max(1, pairs // max(1, len(at)))
        for k in range(0, len(at), rows):
            here = slice(k, k + rows)
            gap = np.clip(at[here, None] - at[None, :], -500, 500)
            p = 1 / (1 + np.exp(gap))
            # A good row loses to a bad one above it, a bad row to a good one below it.
            chance[1, here], chance[0, here] = p @ share[0], (1 - p) @ share[1]
            p *= 1 - p
            slope[1, here], slope[0, here] = p @ share[0], p @ share[1]
            loss += share[1, here] @ np.logaddexp(0, -gap) @ share[0]
        return cls(at, chance, slope, float(loss))

    def of_rows(self, table: np.ndarray, s: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.where(y == 1, np.interp(s, self.at, table[1]), np.interp(s, self.at, table[0]))


def fit(rows: Arrays | Rows, width: int, pairs: int = 4_000_000, epochs: int = 30, l2: float = 1e-4) -> Ranker:
    """Logistic loss on the feature differences of all pairs of a good and a bad row, good preferred.

    A row's share of the gradient depends on its features and on how its strength lies among the strengths
    of the other class. So no pair is formed: each round counts the rows of both classes by strength
    in steps of ``STEP``, then adds up gradient and curvature over all rows. Curvature between the
    classes is left out; a step that does not lower the loss is halved. Rounds end after ``epochs``, or when
    a step promises less than ``ENOUGH``. ``pairs`` is how many pairs of steps are compared at a time.

    Knots and threshold come from counts of all rows in ``FINE`` steps between the least and greatest strength. The
    threshold parts the classes best, both weighing the same, ties in favour of keeping.
    """
    n = rows.total(lambda x, y: np.concatenate([[(y == 0).sum(), (y == 1).sum()], x.sum(axis=0)]))
    if not len(n):
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width))
    size, mean = n[:2], n[2:] / n[:2].sum()
    spread = np.sqrt(rows.total(lambda x, y: ((x - mean) ** 2).sum(axis=0)) / size.sum())
    ranker = Ranker(mean, np.where(spread > 1e-9, spread, 1.0), np.zeros(width))
    if not size.all():
        return ranker

    def odds(weights: np.ndarray) -> _Odds:
        at, counts = rows.counts(replace(ranker, weights=weights).strength, STEP)
        found = _Odds.of(at * STEP, counts, pairs)
        found.loss += l2 / 2 * weights @ weights
        return found

    now = odds(ranker.weights)
    for _ in range(epochs):
        slopes = rows.total(_slopes(ranker, now, size))
        g = slopes[:width] + l2 * ranker.weights
        move = np.linalg.solve(slopes[width:].reshape(width, width) + l2 * np.eye(width), -g)
        share = 1.0
        then = odds(ranker.weights + move)
        while then.loss >= now.loss and share > 1 / 64:
            share /= 2
            then = odds(ranker.weights + share * move)
        if then.loss >= now.loss:
            break
        ranker.weights, now = ranker.weights + share * move, then
        if -g @ move < ENOUGH:
            break
    _settle(ranker, rows, now.at)
    return ranker


def _slopes(ranker: Ranker, odds: _Odds, size: np.ndarray) -> Total:
    """Gradient and curvature of the mean loss over pairs, as one row."""

    def of(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = ranker.scaled(x)
        s, share = z @ ranker.weights, 1 / np.where(y == 1, size[1], size[0])
        pull = odds.of_rows(odds.chance, s, y) * share * np.where(y == 1, -1, 1)
        bend = odds.of_rows(odds.slope, s, y) * share
        return np.concatenate([pull @ z, (z.T @ (z * bend[:, None])).ravel()])

    return of


def _settle(ranker: Ranker, rows: Arrays | Rows, met: np.ndarray) -> None:
    """Put in the knots and the threshold, from the strengths of all rows, which lie among ``met``."""
    low = met.min()
    step = max((met.max() - low) / FINE, 1e-12)
    at, n = rows.counts(lambda x: np.floor((ranker.strength(x) - low) / step), 1.0)
    # Rows of a step lie between its edges.
    some = n.sum(axis=0) > 0
    at, n = at[some], n[:, some]
    edges = low + step * np.stack([at, at + 1], axis=1).ravel()
    ranks = np.concatenate([[0], np.repeat(np.cumsum(n.sum(axis=0)), 2)])[: 2 * len(at)] / n.sum()
    ranker.knots = np.interp(np.linspace(0, 1, 1001), ranks, edges)
    # Right decisions if the cut lies below each step in turn, and above the last.
    bad, good = (np.concatenate(([0], np.cumsum(c))) for c in n)
    k = int(np.argmax(bad / bad[-1] + (good[-1] - good) / good[-1]))
    # In the middle of the gap that no row lies in.
    edge = (edges[max(2 * k - 1, 0)] + edges[min(2 * k, len(edges) - 1)]) / 2
    ranker.cut = float(np.clip(np.interp(edge, ranker.knots, np.linspace(0, 1, 1001)), 1e-6, 1 - 1e-6))


def fit_pairs(x: np.ndarray, y: np.ndarray, **how) -> Ranker:
    """``fit`` over rows in memory."""
    return fit(Arrays(x, y), x.shape[1], **how)


def _measured(text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [measures(r) for r in raw_texts(column_of(batch, text))]
            yield pa.RecordBatch.from_arrays(
                [*(column_of(batch, n) for n in names), pa.array(x, pa.list_(pa.float64()))], names=[*names, "measures"]
            )

    return run


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``measures`` of whole texts in place of ``text``; no shuffle.

    ``train`` and ``score`` take them, so that texts are read once for both. A column ``measures`` is replaced.
    """
    prepare(docs.sparkSession)
    base = docs.drop("measures")
    kept = [f for f in base.schema.fields if f.name != text]
    schema = T.StructType([*kept, T.StructField("measures", T.ArrayType(T.DoubleType()))])
    return base.mapInArrow(_measured(text, [f.name for f in kept]), schema)


def train(
    docs: DataFrame, labels: DataFrame, id_name: str = "doc_id", text: str = "text", label: str = "quality",
    found: str | None = None, **how,
) -> Ranker:
    """Fit on all labelled documents of both classes, 0 and 1; tasks hold a batch of them at a time.

    Labels other than 0 and 1 are not used; an id labelled both counts as 0. Without both classes every
    score is the same. ``found`` names a column of ``measured`` texts, which then are not read.
    """
    prepare(docs.sparkSession)
    marked = labels.select(labels[id_name], labels[label]).where(F.col(label).isin(0, 1))
    texts = with_labels(marked, docs, id_name, found or text, label).withColumnRenamed("text", "measures" if found else "text")
    rows = texts if found else measured(texts)
    table = stored(rows.select(F.col("label").cast("int").alias("label"), "measures"), "ranked")
    return fit(Rows(table), len(expand(measures(None)[None, :])[0]), **how)


def _scored(ranker, text: str, names: list[str], found: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = column_of(batch, text)
            x = _matrix(column) if found else np.array([measures(r) for r in raw_texts(column)])
            scores = ranker.value.score(expand(x)) if len(x) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(scores, pa.float64()) if n == "score" else column_of(batch, n) for n in names], names=names
            )

    return run


def score(docs: DataFrame, ranker: Ranker, text: str = "text", found: str | None = None) -> DataFrame:
    """``docs`` with ``score`` in 0 to 1, from whole texts alone; no shuffle.

    Null and empty texts are scored as texts without words. All rows stay; other columns pass through, a
    column ``score`` is replaced. An empty table gives no rows. ``found`` names a column of ``measured``
    texts, which then are not read.
    """
    spark = prepare(docs.sparkSession)
    base = docs.drop("score")
    schema = T.StructType(base.schema.fields + [T.StructField("score", T.DoubleType())])
    run = _scored(spark.sparkContext.broadcast(ranker), found or text, schema.fieldNames(), bool(found))
    return base.mapInArrow(run, schema)
