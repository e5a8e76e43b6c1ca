"""Documents as the keyed state of a stream, for what must react to each change as it comes.

``transformWithState`` keeps, for each (ns, _id), one value: ``document`` (doc as JSON text, ts, deleted).  It lives in RocksDB on the executors and is
checkpointed with the stream, so a restart goes on where it stopped; a tombstone may expire (``keep_deleted``, a time to live), a document never.
Each batch emits the documents it changed and the entries it couldn't apply, from one shuffle by key.  A document's entries of one batch are applied
in order of time; entries at or before its time are skipped, so entries that come again change nothing.

Documents travel as JSON text, so types that JSON lacks become what ``to_json`` makes of them; ``ParquetTarget`` keeps types.  Commands aren't about one key and are left
out: a log with drops and renames is for ``ParquetTarget``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidelog.operators.replay import UpdateError, apply_delta, is_change, kind

STATE = "doc string, ts long, deleted boolean"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
Changed = Row("ns", "_id", "doc", "ts", "deleted", "reason")
#: The setting that names where state is kept; transformWithState needs RocksDB.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: The setting that says how many partitions the state gets; a checkpoint keeps what it began with.
PARTITIONS = "spark.sql.shuffle.partitions"


class Documents(StatefulProcessor):
    """Applies entries (ts, kind, o, set, unset; values as JSON text) to the document of their key."""

    def __init__(self, keep_deleted: int | None):
        self.keep_deleted = keep_deleted

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.document = handle.getValueState("document", STATE)
        self.tombstone = handle.getValueState("tombstone", "ts long", *([] if self.keep_deleted is None else [self.keep_deleted]))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held, gone = self.document.get(), self.tombstone.get()
        doc, ts = (json.loads(held[0]), held[1]) if held is not None else (None, gone[0] if gone is not None else None)
        changed = False
        for entry in sorted(rows, key=lambda r: r.ts):
            if ts is not None and entry.ts <= ts:
                continue
            if entry.kind == "delete":
                doc, ts, changed = None, entry.ts, True
            elif entry.kind != "delta":
                doc, ts, changed = json.loads(entry.o), entry.ts, True
            elif doc is None:
                yield Changed(*key, None, entry.ts, None, "no_base")
            else:
                try:
                    doc, ts, changed = apply_delta(doc, {k: json.loads(v) for k, v in dict(entry.set or ()).items()}, entry.unset), entry.ts, True
                except UpdateError:
                    yield Changed(*key, None, entry.ts, None, "bad_update")
        if not changed:
            return
        if doc is None:
            self.document.clear()
            self.tombstone.update((ts,))
        else:
            self.document.update((json.dumps(doc), ts, False))
            self.tombstone.clear()
        yield Changed(*key, None if doc is None else json.dumps(doc), ts, doc is None, None)

    def close(self) -> None:
        pass


def documents(stream: DataFrame, keep_deleted: int | None = None) -> DataFrame:
    """A stream of (ns, _id, doc, ts, deleted, reason): each batch's changed documents (reason null), and entries that can't be applied.

    ``keep_deleted`` is in milliseconds; with it the stream keeps looking at the clock, so it never ends by itself and suits triggers that go on.
    Without it, tombstones stay.  Needs ``PROVIDER`` set to ``ROCKSDB``.
    """
    key = stream.schema["_id"].dataType.simpleString()
    rows = stream.where(is_change()).select(
        "ns", "_id", "ts", kind().alias("kind"), F.to_json("o").alias("o"), F.transform_values("set", lambda _, v: F.to_json(v)).alias("set"), "unset"
    )
    out = f"ns string, _id {key}, doc string, ts long, deleted boolean, reason string"
    return rows.groupBy("ns", "_id").transformWithState(Documents(keep_deleted), out, outputMode="Update", timeMode="None" if keep_deleted is None else "ProcessingTime")
