"""Several change logs as one stream, each with a position of its own.

``spark.readStream.format("change_log").option("path", p)`` follows the logs below ``p``: folders ``replset=<name>`` of Parquet files, as
``df.write.partitionBy("replset").mode("append").parquet(p)`` makes them.  A stream's offset maps each log's name to the time of its newest
entry read, so order holds within a log, logs that appear later are read from their beginning, and a stream can go on from the
offset alone (option ``from``, as JSON; entries after it).  A log whose oldest entry is newer than its offset has lost entries nobody has
read: ``unrecoverable``, an error, where a new copy is due.

The stream itself has a row for each file with entries in a batch's range, which the files' footers tell: (replset, file, after, up_to).  Spark's own reader
then reads these files, with the range as a filter on their scan (``entries_of_segments``), so documents never pass through Python.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidelog.sources.change_log import log_schema

PREFIX = "replset="
SEGMENTS = "replset string, file string, after bigint, up_to bigint"


class Logs:
    """The logs below a path, by what their files' footers say."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.store, self.base = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")

    def files(self) -> dict[str, list[tuple[str, int, int]]]:
        """(file, least ts, greatest ts) of each log's files; empty files have no row group and are left out."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        found: dict[str, list[tuple[str, int, int]]] = {}
        for info in self.store.get_file_info(fs.FileSelector(self.base, allow_not_found=True)):
            if info.type != fs.FileType.Directory or not info.base_name.startswith(PREFIX):
                continue
            for part in self.store.get_file_info(fs.FileSelector(info.path)):
                if not part.base_name.endswith(".parquet") or part.base_name.startswith(("_", ".")):
                    continue
                meta = pq.ParquetFile(part.path, filesystem=self.store).metadata
                column = next(k for k in range(meta.num_columns) if meta.schema.column(k).path == "ts")
                stats = [meta.row_group(k).column(column).statistics for k in range(meta.num_row_groups)]
                if stats:
                    found.setdefault(info.base_name.removeprefix(PREFIX), []).append((part.path, min(s.min for s in stats), max(s.max for s in stats)))
        return found


class LogReader(DataSourceStreamReader):
    def __init__(self, path: str, start: dict[str, int]):
        self.path, self.start = path, start

    def initialOffset(self) -> dict:
        return dict(self.start)

    def latestOffset(self, *_) -> dict:
        newest = {name: max(hi for *_, hi in files) for name, files in Logs(self.path).files().items()}
        return {name: max(newest.get(name, self.start.get(name, 0)), self.start.get(name, 0)) for name in sorted({*newest, *self.start})}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """One for each log."""
        out = []
        for name, files in sorted(Logs(self.path).files().items()):
            after, up_to = start.get(name), end.get(name)
            if after is not None and min(lo for _, lo, _ in files) > after:
                raise RuntimeError(f"unrecoverable: log {name} begins after {after}, up to which it has been read")
            own = [path for path, lo, hi in sorted(files) if up_to is not None and lo <= up_to and (after is None or hi > after)]
            out += [InputPartition((name, own, after, up_to))] if own and after != up_to else []
        return out

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        name, files, after, up_to = partition.value
        yield from ((name, file, after, up_to) for file in files)


class ChangeLogSource(DataSource):
    """Options: path; from, an offset to go on from as JSON."""

    @classmethod
    def name(cls) -> str:
        return "change_log"

    def schema(self) -> str:
        return SEGMENTS

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options["path"], json.loads(self.options.get("from", "{}")))


def stream_segments(spark: SparkSession, path: str, start: dict[str, int] | None = None) -> DataFrame:
    """What is to be read of all logs below ``path``, as a stream, from ``start`` (the newest times read of each log) on."""
    spark.dataSource.register(ChangeLogSource)
    return spark.readStream.format("change_log").option("path", path).option("from", json.dumps(start or {})).load()


def entries_of_segments(segments: DataFrame, path: str, key: str = "BIGINT") -> DataFrame:
    """The entries that a batch's segments stand for, read by Spark; a row a file comes to the driver."""
    spark, found = segments.sparkSession, segments.collect()
    schema = log_schema(key)
    if not found:
        return spark.createDataFrame([], schema)
    inside = F.lit(False)
    for name, after, up_to in sorted({(r.replset, r.after, r.up_to) for r in found}, key=str):
        inside = inside | ((F.col("replset") == name) & (F.col("ts") <= up_to) & (F.lit(True) if after is None else F.col("ts") > after))
    scheme = path.partition("://")[0] + "://" if "://" in path else ""
    files = [r.file if "://" in r.file or not scheme else scheme + r.file for r in found]
    rows = spark.read.schema(schema).option("basePath", path).parquet(*files).where(inside)
    return rows.select(*spark.createDataFrame([], schema).columns)
