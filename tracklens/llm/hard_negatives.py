"""Hard negatives by Fagin's threshold algorithm.

Candidates lie in blocks, and each block has one list per dimension, sorted by that component. For an
anchor the lists are read in step, from the top where its component is positive and from the bottom
where it is negative; what turns up is scored by random access, in whole numbers. No candidate that has
not turned up can score above the threshold, the anchor's product with the last values read. Reading
stops once the threshold lies strictly below the kth score of each window, or below the window.
Blocks meet batches of anchors in Spark, and the best of all blocks are ranked there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklens.llm.common import column_of, prepare, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
# A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 50, 95
# Numbers in a block, and anchors in a batch.
BLOCK_VALUES = 1 << 19
BATCH_ROWS = 1024
FIRST_STEP = 4
# Whole numbers up to here are exact in double precision.
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


# ---------------------------------------------------------------- one block


class Block:
    """Candidates with a sorted list per dimension. ``labels`` are numbers; see ``search``."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.x, self.ids, self.labels = x, ids, labels
        self.lists = np.argsort(x, axis=0, kind="stable").T.astype(np.int32)
        self.most = float(np.abs(x).max()) if x.size else 0.0

    def search(self, a: np.ndarray, fit: np.ndarray, windows: list[tuple], k: int) -> tuple[list[list[tuple]], int]:
        """The first ``k`` (score, id) of each window, and how many candidates were scored.

        ``fit`` marks candidates that may be returned. A window (low, high, of) takes scores with
        low * of <= 100 * score <= high * of; None takes all. Higher scores come first, then smaller ids.
        """
        n, x = len(self.ids), self.x
        if float(np.abs(a).max(initial=0)) * self.most * max(1, len(a)) >= _EXACT:
            # Beyond what doubles hold exactly: Python's whole numbers.
            a, x = np.array([int(v) for v in a], object), np.array([[int(v) for v in row] for row in x], object)
        up, down = np.flatnonzero(a > 0), np.flatnonzero(a < 0)
        best: list[list[tuple]] = [[] for _ in windows]
        seen, depth, step = np.zeros(n, bool), 0, FIRST_STEP
        while depth < n:
            end = min(n, depth + step)
            fresh = np.zeros(n, bool)
            fresh[self.lists[up, n - end : n - depth]] = True
            fresh[self.lists[down, depth:end]] = True
            if not len(up) and not len(down):  # all scores are 0
                fresh[:], end = True, n
            new = np.flatnonzero(fresh & ~seen)
            seen |= fresh
            self._take(best, new, x[new] @ a, fit, windows, k)
            depth, step = end, step * 2
            last = np.concatenate([self.lists[up, n - end], self.lists[down, end - 1]])
            dims = np.concatenate([up, down])
            threshold = int((a[dims] * x[last, dims]).sum()) if len(dims) else 0
            if all(self._done(found, w, threshold, k) for found, w in zip(best, windows, strict=True)):
                break
        return best, int(seen.sum())

    def _take(self, best: list[list[tuple]], new: np.ndarray, scores: np.ndarray, fit: np.ndarray, windows: list[tuple], k: int) -> None:
        usable = fit[new]
        new, scores = new[usable], scores[usable]
        for at, window in enumerate(windows):
            rows, values = new, scores
            if window is not None:
                low, high, of = window
                inside = (100 * values >= low * of) & (100 * values <= high * of)
                rows, values = rows[inside], values[inside]
            if len(best[at]) == k:
                good = values >= best[at][-1][0]
                rows, values = rows[good], values[good]
            if len(rows) > k:
                # All that tie with the kth stay until ids decide.
                good = values >= np.sort(values)[-k]
                rows, values = rows[good], values[good]
            found = best[at] + [(int(v), int(i)) for v, i in zip(values, self.ids[rows], strict=True)]
            best[at] = sorted(found, key=lambda f: (-f[0], f[1]))[:k]

    @staticmethod
    def _done(found: list[tuple], window: tuple | None, threshold: int, k: int) -> bool:
        if window is not None and 100 * threshold < window[0] * window[2]:
            return True
        return len(found) == k and threshold < found[-1][0]


def _matrix(table: pa.Table) -> np.ndarray:
    rows = table.column("code").to_pylist()
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1) if rows else np.zeros((0, 0))


def _block(table: pa.Table, names: dict[str, int]) -> Block:
    labels = np.array([names.setdefault(x, len(names)) for x in table.column("label").to_pylist()], np.int64)
    return Block(_matrix(table), table.column("id").to_numpy().astype(np.int64), labels)


def _long(score: int) -> int:
    return max(-_LONG - 1, min(_LONG, score))


def _nearest(k: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and rows.num_rows:
            block = _block(rows, {})
            for name, a in zip(anchors.column("id").to_pylist(), _matrix(anchors), strict=True):
                found, _ = block.search(a, block.ids != name, [None], k)
                out += [(name, other, _long(score)) for score, other in found[0]]
        return _columns(out, ["anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(k: int, low: int, high: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and rows.num_rows:
            names: dict[str, int] = {}
            block = _block(rows, names)
            columns = (anchors.column(n).to_pylist() for n in ("id", "label", "wants"))
            for name, label, wants, a in zip(*columns, _matrix(anchors), strict=True):
                fit = block.labels != names.get(label, -1)
                # Scores are not negative here: another sign would leave no window.
                windows = [(low, high, w["positive_score"]) for w in wants]
                if not fit.any():
                    continue
                found, _ = block.search(a, fit, windows, k)
                for w, pairs in zip(wants, found, strict=True):
                    out += [(name, w["positive_id"], w["positive_score"], other, _long(score)) for score, other in pairs]
        return _columns(out, ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return run


def _columns(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


# ---------------------------------------------------------------- Spark steps


def _coded(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for value in column_of(batch, "vector").to_pylist():
                code = None
                if value is not None and None not in value:
                    with np.errstate(over="ignore", invalid="ignore"):
                        x = np.floor(scale * np.array(value, np.float64))
                    if np.isfinite(x).all():
                        code = x.astype("<f8").tobytes()
                codes.append(code)
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "id"), column_of(batch, "label"), pa.array(codes, pa.binary())], names=["id", "label", "code"]
            )

    return run


def _blocks(size: str, values: int):
    """Blocks for ``size`` vectors, by the numbers they hold."""
    return F.ceil(F.col(size) * F.greatest(F.length("code") / 8, F.lit(1)) / values).cast("int")


def _met(anchors: DataFrame, rows: DataFrame, by: list[str], block_values: int, batch_rows: int):
    """Both sides grouped by cells: every batch of anchors meets every block that is equal in ``by``."""
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("size"))
    asked = anchors.groupBy(*by).agg(F.count(F.lit(1)).alias("asked"))
    both = sizes.join(asked, by)
    deal = lambda into, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(into)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def counted(side: DataFrame) -> DataFrame:
        return side.join(both, by).withColumn("blocks", _blocks("size", block_values)).withColumn(
            "batches", F.ceil(F.col("asked") / batch_rows).cast("int")
        )

    keys = [*by, "batch", "block"]
    left = counted(anchors).withColumn("batch", deal("batches", 5)).withColumn("block", every("blocks"))
    right = counted(rows).withColumn("block", deal("blocks", 6)).withColumn("batch", every("batches"))
    left, right = (side.drop("size", "asked", "blocks", "batches") for side in (left, right))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys))


def mine(
    vectors: DataFrame, id_name: str = "vec_id", vector: str = "embedding", label: str = "label",
    anchor_every: int = 50, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, block_values: int = BLOCK_VALUES, batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components become floor(``scale`` * x); a score is the whole-number inner product with the anchor, higher
    first, ties by smaller id. Anchors are the rows whose id is divisible by ``anchor_every``. An anchor's positives
    are its first ``positives`` other rows of its label; for each, the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * score <= high * positive_score are returned. A positive without such rows gives none.

    Rows with a null id or label, a null vector, or a null or non-finite component (also after scaling) take no
    part. Vectors meet those of their own length; scores of empty ones are 0. Rows that share an id are one row:
    the one with the smallest label, then vector. Scores beyond a long are compared in full within a block and become
    its limit after that. Other columns are not looked at. An empty table gives no rows.

    A task holds one block of at most about ``block_values`` numbers and one batch of anchors, whatever
    the size of a label; every anchor meets every block.
    """
    prepare(vectors.sparkSession)
    slim = vectors.select(
        vectors[id_name].cast("long").alias("id"), vectors[label].cast("string").alias("label"), vectors[vector].alias("vector")
    ).where("id is not null and label is not null")
    coded = slim.mapInArrow(_coded(scale), "id long, label string, code binary").where("code is not null")
    one = coded.groupBy("id").agg(F.min(F.struct("label", "code")).alias("row"))
    rows = one.select("id", "row.label", "row.code", F.length("row.code").alias("width"))
    rows = stored(rows, "negative-rows")
    anchors = stored(rows.where(F.col("id") % anchor_every == 0), "negative-anchors")

    met = _met(anchors, rows, ["label", "width"], block_values, batch_rows)
    near = met.applyInArrow(_nearest(positives), "anchor_id long, positive_id long, positive_score long")
    place = F.row_number().over(W.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    near = near.withColumn("place", place).where(F.col("place") <= positives)
    want = F.collect_list(F.struct("positive_id", "positive_score")).alias("wants")
    # A window of a negative score holds nothing.
    wants = near.where("positive_score >= 0").groupBy("anchor_id").agg(want)
    asking = stored(anchors.join(wants, F.col("id") == F.col("anchor_id")).drop("anchor_id"), "negative-windows")

    met = _met(asking, rows, ["width"], block_values, batch_rows)
    found = met.applyInArrow(
        _negatives(negatives, low, high),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    order = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
