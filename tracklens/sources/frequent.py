"""Heavy keys of a table, noted when it is written and read without a job.

Each write leaves a frequent-items sketch of its rows in a folder beside the table. The sketches are combined
right then, and the keys found heavy become a property of the table, so that a later plan learns them
from the catalog. A property that is behind its table costs speed, never rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.operators.skew import ROWS_PER_TASK
from tracklens.sources.versions import home_of

# Keys a sketch tracks, and keys a property names at most.
_TRACKED = 4_096
_NAMED = 1_000
_PROPERTY = "tracklens.heavy."


def note_heavy_keys(
    df: DataFrame, table: str, column: str, added: bool = False, min_rows: int = ROWS_PER_TASK
) -> None:
    """Note the keys of ``df``, the rows just written to ``table``, in ``column``.

    With ``added`` they came behind rows noted before, else they are all there is. Keys with at least ``min_rows``
    rows in all are named, NULL among them; counts may be a little low. ``df`` is read once,
    one column of it, best from the table itself. The keys are whole numbers or strings.
    """
    spark = df.sparkSession
    folder = f"{home_of(spark, table)}__keys/{column}"
    sketch = F.expr(f"approx_top_k_accumulate(k, {_TRACKED})").alias("sketch")
    made = df.select(F.col(column).alias("k")).agg(sketch)
    made.write.mode("append" if added else "overwrite").parquet(folder)
    top = F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {_TRACKED}), {_NAMED})")
    found = spark.read.schema(made.schema).parquet(folder).agg(top.alias("top")).first()["top"] or []
    pairs = [[t["item"], t["count"]] for t in found if t["count"] >= min_rows]
    listed = json.dumps(pairs).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_PROPERTY}{column}' = '{listed}')")


def known_heavy_keys(spark: SparkSession, table: str, column: str) -> dict | None:
    """Rows of each heavy key as noted last; None for a column that was never noted. Starts no job."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    listed = {r["key"]: r["value"] for r in rows}.get(_PROPERTY + column)
    return None if listed is None else {key: n for key, n in json.loads(listed)}
