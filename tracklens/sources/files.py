"""Folders in whatever file system Spark writes to, seen from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    where, system = _at(spark, path)
    return system.exists(where)


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a folder and all in it; False if it was not there."""
    where, system = _at(spark, path)
    return system.delete(where, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Full paths in a folder; none if it is not there."""
    where, system = _at(spark, path)
    return sorted(f.getPath().toString() for f in system.listStatus(where)) if system.exists(where) else []
