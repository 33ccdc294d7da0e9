"""The upsert held in Spark's state store: no stored row is read or rewritten when events arrive.

A streaming aggregate in update mode keeps, per key and payload column, the greatest order seen and its value, so late
events are resolved exactly as in :mod:`siltline.operators.upsert`. Every trigger emits the rows of the keys it touched;
they are appended as one folder per epoch, and the current table is the newest row of every key.
"""

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from siltline.functions import columns as fx
from siltline.operators.upsert import folded, orderable, payload_columns, split_rejects
from siltline.sources.workspace import files_in, publish_text, read_text

EPOCH, ROW, FULL = "__epoch", "__row", ".full"


def latest_in_state(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Streaming change events -> the current row of every key, to be written in update mode.

    One shuffle by key after a map-side combine. State grows with the keys, at every payload column's value and order,
    and no watermark expires it, since an event of any age may still matter: use the RocksDB provider of ``SETTINGS``,
    which keeps it on disk. The number of its parts is ``spark.sql.shuffle.partitions`` at the first start. Columns
    that cannot be compared (maps) are refused. Events without a sequence are left out: see :func:`split_rejects`.
    """
    ordered, _ = split_rejects(events)
    unfit = [c for c in payload_columns(events, keys) if not orderable(events.schema[c].dataType)]
    if unfit:
        raise ValueError(f"columns that the state store cannot fold: {unfit}")
    return folded(ordered, keys)


class RowLog:
    """The rows that an upsert in the state store has emitted, below ``root``.

    Every epoch is a folder of its own and counts once a small note names it; an epoch that is replayed after a crash
    finds its note or writes another folder. A read takes one shuffle over the rows since the last :meth:`compact`.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), tuple(keys)

    def _notes(self) -> list[str]:
        """Names of the notes a read needs: the newest full one and every epoch after it."""
        names = sorted(n.removesuffix(".json") for n in files_in(self.spark, f"{self.root}/epochs") if n.endswith(".json"))
        full = max((n for n in names if n.endswith(FULL)), default="")
        return [n for n in names if n == full or (not n.endswith(FULL) and n > full.removesuffix(FULL))]

    def _note(self, name: str) -> dict:
        return json.loads(read_text(self.spark, f"{self.root}/epochs/{name}.json"))

    def _publish(self, rows: DataFrame, name: str) -> None:
        folder = f"{name}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/rows/{folder}")
        note = {"folder": folder, "epoch": int(name.removesuffix(FULL)), "schema": rows.schema.json()}
        try:
            publish_text(rows.sparkSession, f"{self.root}/epochs/{name}.json", json.dumps(note))
        except FileExistsError:
            pass  # the same epoch, written by an earlier attempt

    def append(self, batch: DataFrame, epoch: int) -> None:
        """Add the rows of an epoch, once. ``batch`` is run once, as state may be updated only once."""
        self._publish(batch, f"{epoch:012d}")

    def read(self) -> DataFrame:
        """The current table: keys and payload."""
        notes = [self._note(n) for n in self._notes()]
        if not notes:
            raise ValueError(f"{self.root} has no rows yet")
        schema = StructType.fromJson(json.loads(notes[-1]["schema"]))
        payload = [f.name for f in schema if f.name not in self.keys]
        base = f"{self.root}/rows"
        rows = self.spark.read.schema(schema).parquet(*[f"{base}/{n['folder']}" for n in notes])
        # an epoch is told from the folder's name, which starts with its twelve digits
        epoch = "cast(regexp_extract(_metadata.file_path, '/rows/([0-9]{12})[^/]*/[^/]*$', 1) AS bigint)"
        held = ", ".join(map(fx.quoted, payload))
        rows = rows.selectExpr(*map(fx.quoted, self.keys), f"struct({held}) AS {ROW}" if held else f"true AS {ROW}", f"{epoch} AS {EPOCH}")
        newest = rows.groupBy(*map(fx.quoted, self.keys)).agg(F.max_by(ROW, EPOCH).alias(ROW))
        return newest.selectExpr(*map(fx.quoted, self.keys), *([f"{ROW}.*"] if held else []))

    def compact(self) -> None:
        """Write the current table as one folder, from which later reads start. The stream may run meanwhile."""
        notes = self._notes()
        if notes and not notes[-1].endswith(FULL):
            self._publish(self.read(), f"{notes[-1]}{FULL}")


def upsert_in_state(
    events: DataFrame, log: RowLog, checkpoint: str, *, name: str | None = None, trigger: Mapping | None = None
) -> StreamingQuery:
    """Start a query that folds change events in the state store and appends the rows it changes to ``log``.

    The checkpoint holds the table's state: the log alone cannot be continued without it, and its payload columns and
    number of state parts are fixed. Spark's file sink takes no update mode, hence ``foreachBatch``, which here only
    writes what the trigger emitted.
    """

    def append(batch: DataFrame, epoch: int) -> None:
        log.append(batch, epoch)

    writer = latest_in_state(events, log.keys).writeStream.outputMode("update").foreachBatch(append)
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
