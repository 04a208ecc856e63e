"""Row counts per stage.

Every count is taken from something that was written and committed, or is the result of a job. None
comes from counters that tasks add to while they run: those count twice when a stage runs again
after an executor is lost, and not at all when the plan drops the stage.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


class Audit:
    """(stage, n) in the order of the stages."""

    def __init__(self, counts: Mapping[str, int] | None = None) -> None:
        self._known: dict[str, int] = dict(counts or {})

    def note(self, name: str, n: int) -> None:
        self._known[name] = n

    def counts(self) -> dict[str, int]:
        return dict(self._known)

    def __getitem__(self, name: str) -> int:
        """The count of a stage; one that nobody noted raises ``KeyError``, it is not 0."""
        return self._known[name]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self._known.items()), "stage string, n bigint")
