"""What a run has finished, kept beside its files."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from tracklens.sources import files

_SCHEMA = "no int, name string, n long"


class Ledger:
    """Finished steps of one run, with their counts, in a folder that all later attempts see.

    A step's entry is one committed file: it is there whole or not at all.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")
        self._run: str | None = None

    def _read(self, name: str) -> list | None:
        path = f"{self._folder}/{name}"
        if not files.exists(self._spark, path):
            return None
        return self._spark.read.schema(_SCHEMA).parquet(path).orderBy("no").collect() or None

    def counts(self, step: str) -> dict[str, int] | None:
        """The counts of a finished step; None if it is not finished."""
        rows = self._read(step)
        return None if rows is None else {r["name"]: r["n"] for r in rows if r["no"] > 0}

    def finish(self, step: str, counts: dict[str, int] | None = None) -> None:
        rows = [(0, step, None), *((i, k, n) for i, (k, n) in enumerate((counts or {}).items(), 1))]
        frame = self._spark.createDataFrame(rows, _SCHEMA).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self._folder}/{step}")

    def run_id(self) -> str:
        """The same for all attempts of a run, and for no other run."""
        if self._run is None:
            known = self.counts("run")
            if not known:
                known = {uuid.uuid4().hex: 0}
                self.finish("run", known)
            self._run = next(iter(known))
        return self._run
