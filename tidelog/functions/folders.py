"""Folders that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one all executors share, or below the warehouse where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read again, as a target's or a source's table is: lost executors cost no recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path`` whose writing was completed; none where there is no such path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not store.exists(at):
        return []
    done = lambda status: store.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
    return sorted(s.getPath().getName() for s in store.listStatus(at) if s.isDirectory() and done(s))


def begun(spark: SparkSession, path: str) -> list[str]:
    """Names of all folders below ``path``, also of those whose writing broke off."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(s.getPath().getName() for s in store.listStatus(at) if s.isDirectory()) if store.exists(at) else []


def files_in(spark: SparkSession, path: str) -> int:
    """How many files of data a folder has."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sum(s.isFile() and not s.getPath().getName().startswith(("_", ".")) for s in store.listStatus(at))


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder and what is in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
