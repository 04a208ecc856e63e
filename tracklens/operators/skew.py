"""Spreading work: equi joins that hold up when one key owns a large share of
the rows, and inputs with fewer splits than there are cores.

A side that Spark broadcasts by its own size check needs no care: the rows of
the other side stay where they are. Beyond that size the join shuffles, and a
key with a third of all rows would end in one task. ``keyed_join`` then spreads the heavy
keys of a side whose keys repeat, each over as many sub-keys as its rows need tasks. It takes
them from the sketches that were noted when the table was written, or else plans a search that
runs with the join (one pass over that column, no shuffle of rows). Which keys are found
affects only speed; adaptive execution splits what is left.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklens.session import apply_runtime_options
from tracklens.session import size_setting as _bytes

# The sketch tracks this many keys, and at most this many are ever returned, so
# the list brought to the driver is bounded whatever the table's size.
_TRACKED = 4_096
_RETURNED = 1_000

# More rows of one key than this are worth several tasks, at any table size.
ROWS_PER_TASK = 1_000_000

# Less input than this is not worth a task of its own.
_TASK_BYTES = 256 * 1024

_RIGHT_KEY = "__right_key"
_LEFT_SALT = "__left_salt"
_RIGHT_SALT = "__right_salt"

_UNITS = {u: 1024**i for i, u in enumerate(["B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"])}
_SIZE = re.compile(r"Statistics\(sizeInBytes=([0-9.E+]+) (\w+)")


def _estimated_bytes(df: DataFrame) -> float:
    """Spark's own size estimate of ``df``, as its cost explanation states it."""
    said = df.sparkSession.sql("EXPLAIN COST SELECT * FROM {df}", df=df).first()[0]
    found = _SIZE.search(said)
    return float(found[1]) * _UNITS[found[2]] if found else float("inf")


def fits_broadcast(df: DataFrame) -> bool:
    """True when Spark's own size estimate lets it broadcast ``df``."""
    limit = _bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    return limit >= 0 and _estimated_bytes(df) <= limit


def heavy_rows(df: DataFrame, key: str, min_rows: int = ROWS_PER_TASK) -> DataFrame:
    """``(key, rows)`` of each key with at least ``min_rows``; NULL is a key like any other.

    Counts come from a frequent-items sketch and may be a little low; the heaviest ``1000`` keys
    are returned at most. Nothing runs yet.
    """
    sketch = F.expr(f"approx_top_k(k, {_RETURNED}, {_TRACKED})").alias("top")
    top = df.select(F.col(key).alias("k")).agg(sketch).select(F.inline("top")).toDF("key", "rows")
    return top.where(F.col("rows") >= min_rows)


def heavy_keys(df: DataFrame, key: str, min_rows: int = ROWS_PER_TASK) -> dict:
    """``heavy_rows`` as a dictionary, looked up now."""
    return {r["key"]: r["rows"] for r in heavy_rows(df, key, min_rows).collect()}


def _planned_tasks(heavy: DataFrame, rows_per_task: int) -> Column:
    """``heavy_rows`` as one value that is worked out when the join runs: tasks of each key, and of NULL.

    It is a scalar subquery, so nothing runs while the join is planned, and both sides share its result.
    """
    tasks = (F.ceil(F.col("rows") / rows_per_task) + 1).cast("int")
    named = F.when(F.col("key").isNotNull(), F.struct("key", tasks.alias("n")))
    none = F.max(F.when(F.col("key").isNull(), tasks))
    found = heavy.agg(F.map_from_entries(F.collect_list(named)).alias("named"), none.alias("none"))
    return found.select(F.struct("named", "none").alias("tasks")).scalar()


def _sub_keys(key: Column, salts: dict | Column) -> Column:
    """The number of sub-keys of each key; 1 for those not in ``salts``."""
    if isinstance(salts, dict):
        pairs = [F.lit(x) for k, n in salts.items() if k is not None for x in (k, n)]
        named = F.try_element_at(F.create_map(*pairs), key) if pairs else F.lit(None)
        none = F.lit(salts.get(None))
    else:
        named, none = F.try_element_at(salts["named"], key), salts["none"]
    return F.coalesce(F.when(key.isNull(), none).otherwise(named), F.lit(1)).cast("int")


def _repeats(key: Column, spread: dict | Column, repeat: dict | Column) -> Column:
    """Sub-keys of the keys that are heavy on the right alone; NULL there meets nothing."""
    return F.when(key.isNull() | (_sub_keys(key, spread) > 1), F.lit(1)).otherwise(_sub_keys(key, repeat))


def _salted(df: DataFrame, key: str, own: Column, every: Column, name: str) -> DataFrame:
    """``df`` with a sub-key: one of ``own``, or, where ``every`` is more than 1, each of that many on a copy."""
    # The partition number is part of the hash, so exact copies of a row spread
    # too; it is the same on a retried task, unlike a random number.
    one = F.pmod(F.xxhash64(F.spark_partition_id(), *df.columns), own)
    salted = df.withColumn(name, one.cast("int"))
    choice = F.when(F.col(key).isNotNull() & (every > 1), F.sequence(F.lit(0), every - 1))
    return salted.withColumn(name, F.explode(choice.otherwise(F.array(F.col(name)))))


def _same_order(a: T.DataType, b: T.DataType) -> bool:
    """True if equal keys of both types are also found as one key of a map."""
    return a == b or (isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType))


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str | None = None,
    how: str = "inner",
    many: str = "left",
    left_heavy: dict | DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    right_heavy: dict | DataFrame | None = None,
) -> DataFrame:
    """Join on ``left_key = right_key``, keeping only the left key column.

    ``how`` is inner, left, left_semi or left_anti. ``many`` names the side
    (left, right or both) in which one key may repeat without bound, or none; only
    such a side is searched, when the join runs. ``left_heavy`` and ``right_heavy`` give the heavy
    keys where they are known already (``sources.known_heavy_keys``) or searched once for several joins
    (``heavy_rows``); a side known to have none stays in the layout it has. Keys of types that
    Spark has to convert are left to adaptive execution. Other column names must differ between the sides.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join kind: {how}")
    if many not in ("left", "right", "both", "none"):
        raise ValueError(f"unknown side: {many}")
    if many in ("right", "both") and how in ("left_semi", "left_anti"):
        raise ValueError("reduce the right side to distinct keys instead")

    apply_runtime_options(left.sparkSession)
    right = right.withColumnRenamed(right_key or left_key, _RIGHT_KEY)
    on = F.col(left_key) == F.col(_RIGHT_KEY)

    def found(side: DataFrame, key: str, heavy: dict | DataFrame | None) -> dict | Column:
        if isinstance(heavy, dict):
            return {k: -(-n // rows_per_task) + 1 for k, n in heavy.items()}
        return _planned_tasks(heavy_rows(side, key, rows_per_task) if heavy is None else heavy, rows_per_task)

    spread: dict | Column = {}
    repeat: dict | Column = {}
    alike = _same_order(left.schema[left_key].dataType, right.schema[_RIGHT_KEY].dataType)
    broadcast = fits_broadcast(right) or (how == "inner" and fits_broadcast(left))
    if many != "none" and alike and not broadcast:
        if many != "right":
            spread = found(left, left_key, left_heavy)
        if many != "left":
            repeat = found(right, _RIGHT_KEY, right_heavy)
    if isinstance(spread, dict) and isinstance(repeat, dict) and not spread and not repeat:
        return left.join(right, on, how).drop(_RIGHT_KEY)

    ours, theirs = F.col(left_key), F.col(_RIGHT_KEY)
    repeated = _repeats(ours, spread, repeat)
    left = _salted(left, left_key, _sub_keys(ours, spread), repeated, _LEFT_SALT)
    right = _salted(right, _RIGHT_KEY, _repeats(theirs, spread, repeat), _sub_keys(theirs, spread), _RIGHT_SALT)
    joined = left.join(right, on & (F.col(_LEFT_SALT) == F.col(_RIGHT_SALT)), how)
    if many in ("right", "both") and how == "left":
        # A heavy key does occur on the right, so a repeated left row that met
        # no partner in its sub-key is not an unmatched row.
        joined = joined.filter(~((repeated > 1) & theirs.isNull()))
    return joined.drop(_RIGHT_KEY, _LEFT_SALT, _RIGHT_SALT)


def expand_counts(df: DataFrame, count: str, chunk: int = 100_000) -> DataFrame:
    """Repeat every row ``count`` times and drop that column.

    Rows with up to ``chunk`` copies are repeated where they are. Larger counts
    are cut into chunks, and only those chunks are dealt out over the tasks, so no
    task or array has to hold all copies of one row.
    """
    rest = [c for c in df.columns if c != count]
    n = F.col(count).cast("bigint")

    def repeated(rows: DataFrame, times: Column) -> DataFrame:
        copies = F.explode(F.sequence(F.lit(1), times)).alias("__copy")
        return rows.select(*rest, copies).drop("__copy")

    few = repeated(df.filter((n > 0) & (n <= chunk)), n)
    chunks = df.filter(n > chunk).select(
        *rest,
        n.alias("__n"),
        F.explode(F.sequence(F.lit(0), F.floor((n - 1) / chunk))).alias("__chunk"),
    )
    size = F.least(F.lit(chunk), F.col("__n") - F.col("__chunk") * chunk)
    return few.unionByName(repeated(chunks.repartition(*rest, "__chunk"), size))


def use_all_cores(df: DataFrame, bytes_per_core: int = 32 * 1024 * 1024) -> DataFrame:
    """``df``, dealt out anew if it is too small to occupy every core by itself.

    Meant before costly per-row work on small inputs, whose few row groups would
    leave most cores idle. An input with more than ``bytes_per_core`` for each
    core has splits enough: it stays where it is and is not shuffled. A tiny one
    gets no more tasks than it can feed.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = _estimated_bytes(df)
    if size >= cores * bytes_per_core:
        return df
    tasks = min(cores, int(size // _TASK_BYTES))
    return df.repartition(tasks) if tasks > 1 else df
