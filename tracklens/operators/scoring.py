"""Running a user's scorer over tracks in bulk."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

RowScorer = Callable[[dict], dict]
# Bytes of a batch that are records at a time: as Python objects they take several times that.
_SLICE_BYTES = 4 * 1024 * 1024
# Gives a result per record, in order; an exception in place of one marks that row.
Scorer = Callable[[list[dict]], list[dict | Exception]]


def row_by_row(make_scorer: Callable[[], RowScorer]) -> Callable[[], Scorer]:
    """A batch scorer from one that takes a single record; failures stay with their row."""

    def make() -> Scorer:
        scorer = make_scorer()

        def score(records: list[dict]) -> list[dict | Exception]:
            found: list[dict | Exception] = []
            for record in records:
                try:
                    found.append(scorer(record))
                except Exception as e:  # one bad track must not end the run
                    found.append(e)
            return found

        return score

    return make


def _values(column: pa.Array) -> list:
    """Python values; lists of floats as NumPy arrays, whole numbers never as floats."""
    if pa.types.is_list(column.type) and pa.types.is_floating(column.type.value_type):
        return [s.values.to_numpy(zero_copy_only=False) if s.is_valid else None for s in column]
    return column.to_pylist()


def _bare(found: dict | Exception) -> dict | Exception:
    """Errors without their stack: its frames hold the batch, and a list in them the errors in turn."""
    left = [found] if isinstance(found, Exception) else []
    while left:
        e = left.pop()
        if e is not None and e.__traceback__:
            e.__traceback__ = None
            left += [e.__cause__, e.__context__]
    return found


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in equal parts of some ``_SLICE_BYTES``; a row is never cut."""
    parts = max(1, min(batch.num_rows, -(-batch.nbytes // _SLICE_BYTES)))
    rows = max(1, -(-batch.num_rows // parts))
    for at in range(0, max(1, batch.num_rows), rows):
        yield batch.slice(at, rows)


def _tried(scorer: Scorer, records: list[dict]) -> list[dict | Exception]:
    """Results for ``records``; a batch that fails as a whole is halved until its bad rows stand alone."""
    try:
        found = [_bare(f) for f in scorer(records)]
        if len(found) != len(records):
            raise ValueError(f"{len(found)} results for {len(records)} records")
        return found
    except Exception as e:
        if len(records) == 1:
            return [_bare(e)]
        half = len(records) // 2
        return _tried(scorer, records[:half]) + _tried(scorer, records[half:])


def _fields(found: list[dict | Exception], schema: pa.Schema) -> tuple[list[pa.Array], list]:
    """The result columns and the errors; a value that does not fit fails its row."""
    errors = [f if isinstance(f, Exception) else None for f in found]
    columns: list[list[Any]] = []
    for field in schema:
        values = [None if e else f.get(field.name) for f, e in zip(found, errors, strict=True)]
        try:
            pa.array(values, field.type)
        except (pa.ArrowException, TypeError, ValueError, OverflowError):
            for i, v in enumerate(values):
                try:
                    pa.array([v], field.type)
                except (pa.ArrowException, TypeError, ValueError, OverflowError) as e:
                    errors[i] = errors[i] or e
                    values[i] = None
        columns.append(values)
    arrays = [
        pa.array([None if e else v for v, e in zip(c, errors, strict=True)], f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return arrays, [f"{type(e).__name__}: {e}" if e else None for e in errors]


def score_batches(
    df: DataFrame,
    make_scorer: Callable[[], Scorer],
    schema: T.StructType | str,
    key: str = "track_id",
    partitions: int | None = None,
) -> DataFrame:
    """Score every row; returns the key, the columns of ``schema`` and ``error``.

    ``make_scorer`` runs once per worker process, at its first batch, so a model is
    loaded where it is used and never shipped. It gives a function of a list of
    records that returns as many results (``row_by_row`` makes one from a function of
    a single record). If a batch fails, its halves are scored, and theirs, so k bad rows among n
    cost some 2 k log n calls; a failing row gets the message in ``error`` and NULLs elsewhere, and the others go on. Keys
    pass through as they are, and whole numbers and NULLs reach the scorer as such. Batches with
    more than 4 MiB of values are scored in parts, so long texts do not fill memory.
    ``partitions`` deals the rows out anew where scoring is far dearer than
    reading. Lists of floats arrive as NumPy arrays; with long ones, set
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` so that a batch fits memory.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    out = T.StructType(
        [df.schema[key]] + schema.fields + [T.StructField("error", T.StringType())]
    )
    arrow = to_arrow_schema(schema)
    names = out.fieldNames()
    call = uuid.uuid4().hex

    def scorer_here() -> Scorer:
        # Worker processes outlive a task, and so does what their main module holds.
        held = vars(sys.modules["__main__"]).setdefault("_tracklens_scorer", {})
        if call not in held:
            held.clear()
            held[call] = make_scorer()
        return held[call]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _slices(whole)):
            columns = [_values(c) for c in batch.columns]
            records = [dict(zip(batch.schema.names, row)) for row in zip(*columns, strict=True)]
            found = _tried(scorer_here(), records) if records else []
            fields, errors = _fields(found, arrow)
            keys = batch.column(batch.schema.get_field_index(key))
            yield pa.RecordBatch.from_arrays([keys, *fields, pa.array(errors, pa.string())], names)

    if partitions:
        df = df.repartition(partitions)
    return df.mapInArrow(run, out)


def split_errors(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(results, errors) of a scored frame.

    Both read ``scored``, so materialise it first where scoring is expensive.
    """
    ok = scored.filter(F.col("error").isNull()).drop("error")
    return ok, scored.filter(F.col("error").isNotNull())
