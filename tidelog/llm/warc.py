"""WARC archives: one gzip member per record, written and read by Spark tasks.

``write_archives`` turns each row into a record.  Of rows whose payloads are equal and have
``LEAST_BYTES`` bytes at least, that with the least key is a ``response`` and holds the payload;
the others are ``revisit`` records that refer to it and hold only its digest and length.  Digests
are computed and grouped without the payloads, so only (key, digest) pairs are shuffled: the
groups of two or more are joined back to the rows, by broadcast if their counted size is within
``BROADCAST_BYTES``, else by a shuffle on the digest that Spark can split where it is skewed.

A task writes files of about ``ROLL_BYTES`` into the shared folder, named after its attempt, and
returns their names; the manifest, a Parquet table, lists only the files of attempts that Spark
committed, so leftovers of lost executors are never read.

``read_archives`` reads the listed files in sequence: blocks of ``READ_BYTES`` go through
incremental zlib decompression, a new member starts where the last one ended, the record's block is
framed by its Content-Length, and block and payload digests are verified.  A damaged record raises.

Null payloads count as empty.  Rows of null key are written after the others: a null key is never
the least of its group unless all are.  Rows repeated under one key are all responses, or all revisits.
An empty table gives an empty archive.  Only the three named columns are written; other columns' names don't matter.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import scratch

LEAST_BYTES = 100
ROLL_BYTES = 32 << 20
READ_BYTES = 1 << 16
BROADCAST_BYTES = 32 << 20
LEVEL = 6
FILES = "path string, records long, bytes long"


def record(kind: str, target: str, key: str, payload: bytes, size: int, digest: str, refers: str | None) -> bytes:
    """One record, not compressed."""
    if kind == "response":
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + payload
    else:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{key}>", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {target}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines[4:4] = [f"WARC-Refers-To: <urn:page:{refers}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    """A gzip member with no time stamp."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def members(blocks: Iterator[bytes]) -> Iterator[bytes]:
    """The content of each gzip member of a stream, decompressed piece by piece."""
    unpacker, held = zlib.decompressobj(31), []
    begun = False
    for block in blocks:
        while block:
            held.append(unpacker.decompress(block))
            begun = True
            block = b""
            if unpacker.eof:
                yield b"".join(held)
                block, unpacker, held, begun = unpacker.unused_data, zlib.decompressobj(31), [], False
    if begun:
        raise ValueError("an archive ends within a record")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record; raises if framing or a digest is wrong."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    size = int(headers["Content-Length"])
    block = rest[:size]
    if not version.startswith("WARC/") or len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("a record isn't framed by its Content-Length")
    if headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError("a record's block differs from its digest")
    payload = block.partition(b"\r\n\r\n")[2]
    if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != f"sha256:{hashlib.sha256(payload).hexdigest()}":
        raise ValueError("a record's payload differs from its digest")
    return headers, payload


def _one_line(url: str | None) -> str:
    return "".join(c if c not in "\r\n" else " " for c in url or "")


def plan_records(df: DataFrame, key: str = "page_id", payload: str = "html") -> DataFrame:
    """``df`` with _size, _digest and _first: the least key of its payload's group, if the group has several rows."""
    data = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    sized = df.withColumns({"_size": F.octet_length(data).cast("long"), "_digest": F.sha2(data, 256)})
    large = sized.where(F.col("_size") >= LEAST_BYTES)
    groups = large.groupBy("_digest").agg(F.min(key).alias("_first"), F.count("*").alias("n"))
    path = scratch(df.sparkSession, "warc-groups")
    groups.where("n > 1").drop("n").write.parquet(path)
    groups = df.sparkSession.read.parquet(path)
    if groups.count() * 100 <= BROADCAST_BYTES:
        groups = F.broadcast(groups)
    # short payloads, many of which are alike, take no part in the join
    rest = sized.where(F.col("_size") < LEAST_BYTES).withColumn("_first", F.lit(None).cast(df.schema[key].dataType))
    joined = large.join(groups, "_digest", "left")
    return joined.unionByName(rest.select(*joined.columns))


def write_archives(df: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Writes the records below ``path`` and returns the manifest (path, records, bytes)."""
    planned = plan_records(df.select(key, url, payload), key, payload)
    rows = planned.select(F.col(key).cast("string").alias("k"), F.col(url), F.col(payload), "_size", "_digest", F.col("_first").cast("string").alias("first"))
    spark = df.sparkSession

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        task = TaskContext.get()
        store, base = fs.FileSystem.from_uri(f"{path}/archives" if ":" in path else f"file://{path}/archives")
        store.create_dir(base, recursive=True)
        out, name, number, records, size, listed = None, "", 0, 0, 0, []
        for part in parts:
            for k, u, p, n, digest, first in zip(*(part.column(i) for i in range(6))):
                k, first = k.as_py(), first.as_py()
                kind = "revisit" if first is not None and first != k else "response"
                data = (p.as_py() or "").encode("utf-8") if kind == "response" else b""
                packed = member(record(kind, _one_line(u.as_py()), k or "", data, n.as_py(), digest.as_py(), first))
                if out is None:
                    name = f"{base}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{number:04d}.warc.gz"
                    out = store.open_output_stream(name, compression=None)
                out.write(packed)
                records, size = records + 1, size + len(packed)
                if size >= ROLL_BYTES:
                    out.close()
                    listed.append((name, records, size))
                    out, number, records, size = None, number + 1, 0, 0
        if out is not None:
            out.close()
            listed.append((name, records, size))
        names, counts, sizes = list(zip(*listed)) or ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["path", "records", "bytes"])

    rows.mapInArrow(write, FILES).write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def read_archives(manifest: DataFrame, path: str, with_payload: bool = False) -> DataFrame:
    """A row for each record of the listed files: key, url, payload_bytes, payload_digest, record_type, refers_to, and
    the payload if asked for."""
    names = ["key", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()] + [pa.binary()] * with_payload

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
        for part in parts:
            for name in part.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(name, compression=None) as stream:
                    for data in members(iter(lambda: stream.read(READ_BYTES), b"")):  # noqa: B023
                        headers, payload = parse(data)
                        refers = headers.get("WARC-Refers-To")
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        size = len(payload) if headers["WARC-Type"] == "response" else int(headers["X-Payload-Length"])
                        row = (headers["WARC-Record-ID"][10:-1] or None, headers["WARC-Target-URI"], size, digest, headers["WARC-Type"], refers and refers[10:-1])
                        rows.append((*row, payload) if with_payload else row)
                        held += 200 + len(payload) * with_payload
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    files = manifest.count()
    schema = "key string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string" + ", payload binary" * with_payload
    return manifest.select("path").repartition(max(1, files)).mapInArrow(read, schema)


def warc_round_trip(spark: SparkSession, df: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every page, read back from archives."""
    path = scratch(spark, "warc")
    found = read_archives(write_archives(df, path), path)
    kind = df.schema["page_id"].dataType
    return found.select(F.col("key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


def oracle(source: str = "pages") -> str:
    """The same rows for DuckDB."""
    return f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM {source}),
g AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= {LEAST_BYTES} GROUP BY ALL HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""
