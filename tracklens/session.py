"""Session options and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Runtime options the plans are written for. ``forceOptimizeSkewedJoin`` lets
# adaptive execution split a hot key even where that costs one more shuffle.
RUNTIME_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Partitions are joined up to this many shuffled bytes at most. Rows of ids shrink to some 9 bytes each on
# the way, but a task that sorts and counts them takes 200 to 400 for each.
MOST_ADVISORY = 8 * 1024 * 1024
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

# Submit-time sizes for a production batch, for ``SparkSession.builder``. Plans lower the first one to
# ``MOST_ADVISORY``.
BATCH_OPTIONS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256mb",
    "spark.sql.files.maxPartitionBytes": "256mb",
    "spark.sql.files.maxRecordsPerFile": "1000000",
}


def size_setting(text: str) -> int:
    """Bytes of a size setting such as ``10485760b``, ``10MB`` or ``-1``."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)i?b?", text.strip().lower()).groups()
    return int(number) * 1024 ** " kmgtp".index(unit or " ")


def apply_runtime_options(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_OPTIONS.items():
        spark.conf.set(key, value)
    if size_setting(spark.conf.get(_ADVISORY)) > MOST_ADVISORY:
        spark.conf.set(_ADVISORY, f"{MOST_ADVISORY}b")
    return spark


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tracklens-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, never reused folder below the one shared by all executors.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(
                "set spark.checkpoint.dir to a folder all executors can reach"
            )
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
