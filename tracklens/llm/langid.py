"""Language identification by averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklens.llm.common import column_of, prepare
from tracklens.llm.samples import even_sample, with_texts

BUCKETS = 1 << 16
SIZES = (1, 2, 3, 4)
SAMPLE_PER_LANGUAGE = 1500
SNIPPETS, SNIPPET_WORDS, SNIPPET_LETTERS = 4, 40, 64
# Documents of all languages together.
SAMPLE_ROWS = 96_000
# Words of more characters are read in stretches, and not remembered.
LONG = 4096
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each subword of marked words, and where each word's subwords start."""
    return _subwords([f"<{w}>" for w in words], None)


def _subwords(marked: list[str], begun: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The same for words with their marks; with ``begun`` only those that begin in that many first places."""
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    ends = np.cumsum(sizes)
    place = np.arange(len(points))
    left = np.repeat(ends, sizes) - place  # points up to the word's end
    counts = np.full(len(points), True) if begun is None else place - np.repeat(ends - sizes, sizes) < begun
    word = np.repeat(np.arange(len(marked)), sizes)
    buckets, owners = [], []
    h = np.zeros(len(points), np.uint64)
    for n in range(1, max(SIZES) + 1):
        shifted = np.zeros(len(points), np.uint64)
        shifted[: max(0, len(points) - n + 1)] = points[n - 1 :]
        h = (h + shifted + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        if n in SIZES:
            fine = (left >= n) & counts
            buckets.append((h[fine] >> np.uint64(7)) % np.uint64(BUCKETS))
            owners.append(word[fine])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    starts = np.searchsorted(owner[order], np.arange(len(marked)))
    return np.concatenate(buckets)[order].astype(np.int64), starts


@dataclass
class LanguageModel:
    languages: list[str]
    embeddings: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0

    def probabilities(self, mean: np.ndarray) -> np.ndarray:
        logits = (mean @ self.softmax + self.bias) / self.temperature
        e = np.exp(logits - logits.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)


class Reader:
    """Mean embeddings of whole texts; remembers a bounded number of words."""

    MOST = 1 << 17

    def __init__(self, model: LanguageModel):
        self.model, self.size = model, model.embeddings.shape[1]
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1 << 12, self.size + 1), np.float32)

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.rows]
        if len(self.rows) + len(new) > self.MOST:
            self.rows.clear()
            new = list(words)
        step = max(1, (1 << 17) // max(32, max(map(len, new), default=0)))
        for at in range(0, len(new), step):
            part = new[at : at + step]
            buckets, starts = subwords(part)
            sums = np.add.reduceat(self.model.embeddings[buckets], starts, axis=0)
            first = len(self.rows)
            while first + len(part) > len(self.table):
                self.table = np.concatenate((self.table, np.zeros_like(self.table)))
            self.table[first : first + len(part), :-1] = sums
            self.table[first : first + len(part), -1] = np.diff(np.append(starts, len(buckets)))
            self.rows.update(zip(part, range(first, first + len(part)), strict=True))

    def _long(self, word: str) -> np.ndarray:
        """Sum and number of a long word's subwords, a stretch of their beginnings at a time."""
        marked, total = f"<{word}>", np.zeros(self.size + 1)
        for at in range(0, len(marked), LONG):
            buckets, _ = _subwords([marked[at : at + LONG + max(SIZES) - 1]], LONG)
            total[:-1] += self.model.embeddings[buckets].sum(axis=0, dtype=np.float64)
            total[-1] += len(buckets)
        return total

    def mean(self, text: str) -> np.ndarray:
        words = text.lower().split()
        total = np.zeros(self.size + 1)
        if len(text) > LONG:
            for w in words:
                if len(w) > LONG:
                    total += self._long(w)
            words = [w for w in words if len(w) <= LONG]
        # In stretches, so that a long text does not grow what is remembered.
        for at in range(0, len(words), 1 << 15):
            part = words[at : at + (1 << 15)]
            self._learn(set(part))
            at_rows = np.fromiter(map(self.rows.__getitem__, part), np.int64, len(part))
            total += self.table[at_rows].sum(axis=0, dtype=np.float64)
        return total[:-1] / max(1.0, total[-1])

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, and whether it is high enough to accept."""
        if text is None or not _LETTER.search(text):
            return UNKNOWN, 0.0, False
        p = self.model.probabilities(self.mean(text))
        best = int(p.argmax())
        return self.model.languages[best], float(p[best]), bool(p[best] >= self.model.least)


def fit(
    snippets: list[str], languages: list[str], size: int = 16, epochs: int = 4, rate: float = 0.5,
    precision: float = 0.99, seed: int = 7,
) -> LanguageModel:
    """Stochastic gradient descent on snippets; every fifth is kept to calibrate.

    The temperature minimises the loss of the kept snippets. A prediction is accepted from the lowest
    probability on, above which ``precision`` of the kept snippets are right.
    """
    names = sorted(set(languages))
    y = np.array([names.index(x) for x in languages], np.int64)
    rng = np.random.default_rng(seed)
    model = LanguageModel(
        names, rng.uniform(-1 / size, 1 / size, (BUCKETS, size)).astype(np.float32),
        np.zeros((size, len(names))), np.zeros(len(names)),
    )
    if not names:
        return model
    bags = []
    for s in snippets:
        ids, n = np.unique(subwords(s.lower().split() or [""])[0], return_counts=True)
        bags.append((ids, (n / n.sum()).astype(np.float32)))
    kept = np.arange(len(bags)) % 5 == 4
    train = np.flatnonzero(~kept)
    steps, done = epochs * len(train), 0
    for _ in range(epochs):
        for i in rng.permutation(train):
            step = rate * (1 - done / steps)
            done += 1
            ids, share = bags[i]
            mean = share @ model.embeddings[ids]
            logits = mean @ model.softmax + model.bias
            e = np.exp(logits - logits.max())
            error = e / e.sum()
            error[y[i]] -= 1
            back = model.softmax @ error
            model.softmax -= step * np.outer(mean, error)
            model.bias -= step * 0.1 * error
            # The mean spreads the gradient thin over the subwords; scale it up again.
            model.embeddings[ids] -= (step * min(len(ids), 64)) * np.outer(share, back).astype(np.float32)
    _calibrate(model, [bags[i] for i in np.flatnonzero(kept)], y[kept], precision)
    return model


def _calibrate(model: LanguageModel, bags: list, y: np.ndarray, precision: float) -> None:
    if not bags:
        return
    means = np.stack([share @ model.embeddings[ids] for ids, share in bags])
    best = None
    for t in np.geomspace(0.1, 10, 41):
        model.temperature = float(t)
        p = model.probabilities(means)
        loss = -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()
        if best is None or loss < best[0]:
            best = (loss, float(t))
    model.temperature = best[1]
    p = model.probabilities(means)
    top, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-top, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(share >= precision)
    model.least = float(top[order[good[-1]]]) if len(good) else 1.0


def _stretch(word: str, rng: np.random.Generator) -> str:
    """A long word's stretch from anywhere in it, so that scripts without spaces are learned whole."""
    if len(word) <= SNIPPET_LETTERS:
        return word
    at = int(rng.integers(0, len(word) - SNIPPET_LETTERS + 1))
    return word[at : at + SNIPPET_LETTERS]


def _snippets():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, out = [], [], []
            for doc, mark, text in zip(*(column_of(batch, n).to_pylist() for n in ("id", "label", "text")), strict=True):
                words = (text or "").split()
                if not _LETTER.search(text or ""):
                    continue
                rng = np.random.default_rng(doc & 0xFFFFFFFF)
                for k in range(SNIPPETS):
                    length = int(rng.integers(3, SNIPPET_WORDS + 1))
                    at = int(rng.integers(0, max(1, len(words) - length + 1)))
                    piece = " ".join(_stretch(w, rng) for w in words[at : at + length])
                    if k == 0 or len(words) > length:
                        ids.append(doc)
                        marks.append(mark)
                        out.append(piece)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(marks, pa.string()), pa.array(out, pa.string())],
                names=["id", "label", "snippet"],
            )

    return run


def train(
    docs: DataFrame, id_name: str = "doc_id", text: str = "text", lang: str = "lang",
    sample_per_language: int = SAMPLE_PER_LANGUAGE, sample_rows: int = SAMPLE_ROWS, **how,
) -> LanguageModel:
    """Fit on at most ``sample_per_language`` documents of every language, and ``sample_rows`` in all.

    However many languages there are, each has its even share of those. Each document gives at most four
    snippets of up to 40 words from anywhere in its text, long words by a stretch of 64 letters from anywhere
    in them. Rows with a null id, language or no letters are not used. Without rows no language can be
    predicted.
    """
    prepare(docs.sparkSession)
    sample = even_sample(docs.select(id_name, lang), id_name, lang, sample_per_language, sample_rows)
    rows = with_texts(sample, docs, id_name, text, "label", sampled="id").mapInArrow(
        _snippets(), "id long, label string, snippet string"
    ).toArrow().sort_by([("id", "ascending"), ("snippet", "ascending")])
    return fit(rows.column("snippet").to_pylist(), rows.column("label").to_pylist(), **how)


def _predicted(model, text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.value)
        for batch in batches:
            found = [reader.predict(t) for t in column_of(batch, text).to_pylist()]
            made = {
                "lang_pred": pa.array([f[0] for f in found], pa.string()),
                "score": pa.array([f[1] for f in found], pa.float64()),
                "accepted": pa.array([f[2] for f in found], pa.bool_()),
            }
            yield pa.RecordBatch.from_arrays([made[n] if n in made else column_of(batch, n) for n in names], names=names)

    return run


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``accepted``, from whole texts alone; no shuffle.

    ``score`` is the calibrated probability of ``lang_pred``; ``accepted`` is false where it is below
    the rejection limit, so that a caller can put ``und`` there. A text that is null or has no letter is
    ``und`` with score 0, and so is every text if no language was learned. Other columns pass
    through, columns of these names are replaced. An empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    made = [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("accepted", T.BooleanType()),
    ]
    base = docs.drop(*(f.name for f in made))
    schema = T.StructType(base.schema.fields + made)
    if not model.languages:
        return base.select(
            "*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted")
        )
    shared = spark.sparkContext.broadcast(model)
    return base.mapInArrow(_predicted(shared, text, schema.fieldNames()), schema)
