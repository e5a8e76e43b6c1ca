"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whole texts are worked on so many bytes at a time (Spark itself sends batches of up to 64 MB).
PIECE_BYTES = 4 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or (only where that is unset, and Spark runs
    on this machine alone, as in tests) a temporary folder."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(base)
        return base.rstrip("/")
    if not context.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir().rstrip("/")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its store's scheme, as Spark resolves it: the same place for every executor and for Spark's own readers."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(at).toString()
    return found.replace("file:/", "file:///", 1) if found.startswith("file:/") and not found.startswith("file://") else found


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    return f"{qualified(spark, shared_dir(spark))}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder, so that lost executors cost no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read again: smaller than a checkpoint, and there only until the path is removed."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def columns(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names have."""
    return [F.col(f"`{name}`") for name in df.columns]


def bound_batches(spark: SparkSession) -> None:
    """Has Spark send at most PIECE_BYTES to Python at a time.  For jobs that own their session, as the registered queries do; operators leave it alone."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(PIECE_BYTES))


def pieces(parts: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about PIECE_BYTES of one column; one value alone may be longer."""
    for part in parts:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(part.column(column)), 0).to_numpy(zero_copy_only=False))
        ends = np.unique(np.append(np.searchsorted(sizes, np.arange(PIECE_BYTES, sizes[-1] if len(sizes) else 0, PIECE_BYTES)) + 1, part.num_rows))
        for begin, end in zip([0, *ends.tolist()], ends.tolist()):
            if end > begin:
                yield part.slice(begin, end - begin)
