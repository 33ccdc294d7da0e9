"""A keyed target kept as bucketed Parquet, for clusters without a table format that offers MERGE.

Layout below ``root``:

    data/attempt=A/silt_kind=state/silt_bucket=B/      state rows of bucket B as attempt A wrote them
    data/attempt=A/silt_kind=<change type>/...         the row images that this commit's change feed consists of; there
                                                       are none if all rows were new, which are their own images
    rejects/attempt=A/                                 events of that commit that had no sequence
    manifest/<version>.json                            the attempt that became this version, which attempt holds each
                                                       live bucket, schema, counts and running totals

A commit rewrites only the buckets it touches, in folders named by an id of its own, so it can neither overwrite nor be
taken for another. It becomes visible when its manifest does, which appears whole and never replaces one: a version is a
finished manifest, whatever else a writer that died may have left. Of two writers that race for a version one fails, and
the other's data stay as they are. Each commit records the last epoch of its writer, so a replayed micro-batch is
recognised and skipped.

A column whose type grows widens the table's from that commit on; files written before are read with the wider type.
"""

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from copy import copy
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from siltline.functions import columns as fx
from siltline.operators.changes import CHANGE_TYPE, COMMIT_TIME, COMMIT_VERSION, net_changes
from siltline.operators.state import BEFORE, BUCKET, CHANGE, EVENTS, KIND, STATE, absorb, images
from siltline.operators.upsert import (
    HOT_ROWS,
    HOT_SLOTS,
    SEQ,
    condense_hot_keys,
    split_rejects,
)
from siltline.operators.widening import as_stored, widened
from siltline.sources.workspace import files_in, publish_text, read_text, remove, subfolders

COUNTS = ("events", "rejected", "inserted", "updated")
MANIFEST = f"""version int, attempt string, committed_at timestamp, {", ".join(f"{c} bigint" for c in COUNTS)}, rows bigint,
    bucket_count int, held_by map<string,string>, epochs map<string,bigint>, row_schema string, reject_schema string,
    totals struct<commits:bigint,{",".join(f"{c}:bigint" for c in COUNTS)}>"""


# A merge whose events have more cells than this, rows times columns, takes its buckets in several rounds. 1.2 million
# events of 131 columns were 459 MB of shuffle, so a round is some 12 GB; each one reads the events again.
ROUND_CELLS = 1 << 32


@dataclass(frozen=True)
class Layout:
    """The newest commit: which attempt holds each live bucket, the row schema, each writer's last epoch, and what all
    commits up to now add up to."""

    version: int = 0
    rows: int = 0
    held_by: dict[int, str] = field(default_factory=dict)
    epochs: dict[str, int] = field(default_factory=dict)
    schema: StructType | None = None
    reject_schema: StructType | None = None
    totals: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("commits", *COUNTS), 0))


class ConcurrentCommit(RuntimeError):
    """Another writer has published the version that this one was to become; merge again."""


class KeyedTable:
    """Current-state table over ``keys``, upserted with change events and readable at any time."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str],
        *,
        buckets: int = 32,
        splits: int = 4,
        hot_rows: int | None = HOT_ROWS,
        track_changes: bool = True,
        round_cells: int = ROUND_CELLS,
    ):
        """``buckets`` is fixed for the life of the table; aim at 0.5 to 1 GB of data per bucket. Each bucket is
        merged by up to ``splits`` tasks and written as as many files.

        ``hot_rows`` bounds the events of one key a task sees at once. Without ``track_changes`` the change feed
        holds inserts only. ``round_cells`` bounds what a merge shuffles before it writes.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = tuple(keys)
        self.buckets = buckets
        self.splits = splits
        self.hot_rows = hot_rows
        self.track_changes = track_changes
        self.round_cells = round_cells

    def using(self, spark: SparkSession) -> "KeyedTable":
        """The same table through another session."""
        other = copy(self)
        other.spark = spark
        return other

    def _bucket(self) -> str:
        return fx.key_slot(self.keys, self.buckets)

    # ---- reading

    def versions(self) -> list[int]:
        """The committed versions, from the names of the finished manifests."""
        names = files_in(self.spark, f"{self.root}/manifest")
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifest/{version:012d}.json"

    def _manifests(self, versions: Sequence[int]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], MANIFEST)
        reader = self.spark.read.schema(MANIFEST).option("mode", "FAILFAST")
        return reader.json([self._manifest(v) for v in versions])

    def commits(self) -> DataFrame:
        """One row per commit, with its counts. Empty before the first one."""
        return self._manifests(self.versions())

    def layout(self) -> Layout:
        """What the newest manifest says; it alone is read, by the driver. One that cannot be read is an error."""
        versions = self.versions()
        if not versions:
            return Layout()
        newest = json.loads(read_text(self.spark, self._manifest(versions[-1])))
        if newest["bucket_count"] != self.buckets:
            raise ValueError(f"{self.root} has {newest['bucket_count']} buckets, not {self.buckets}")
        schemas = [newest.get(s) for s in ("row_schema", "reject_schema")]
        schema, rejects = (StructType.fromJson(json.loads(s)) if s else None for s in schemas)
        held_by = {int(b): attempt for b, attempt in newest["held_by"].items()}
        return Layout(newest["version"], newest["rows"], held_by, newest["epochs"], schema, rejects, newest["totals"])

    def bucket_paths(self, layout: Layout | None = None) -> dict[int, str]:
        """Where each live bucket lies."""
        held_by = (layout or self.layout()).held_by
        return {b: f"{self.root}/data/attempt={a}/{KIND}={STATE}/{BUCKET}={b}" for b, a in sorted(held_by.items())}

    def _rows(self, layout: Layout, only: Sequence[int] | None = None) -> DataFrame | None:
        """State rows of all or some live buckets; no file of any other bucket is listed or read."""
        paths = [p for b, p in self.bucket_paths(layout).items() if only is None or b in only]
        return self.spark.read.schema(layout.schema).parquet(*paths) if paths else None

    def read(self) -> DataFrame:
        """The target: keys and payload, without the merge's own columns."""
        rows = self._rows(self.layout())
        if rows is None:
            raise ValueError(f"{self.root} has no rows yet")
        return rows.drop(EVENTS)

    def changes(self, since: int = 1, until: int | None = None) -> DataFrame:
        """The change feed of versions ``since..until``; reads the files that hold those images and no other."""
        layout = self.layout()
        if layout.schema is None:
            raise ValueError(f"{self.root} has no rows yet")
        versions = [v for v in self.versions() if v >= since and (until is None or v <= until)]
        commits = self._manifests(versions).where("inserted + updated > 0")
        commits = commits.select("version", "attempt", "committed_at").collect()  # one short row per commit asked for
        data = f"{self.root}/data"
        paths = [p for c in commits for p in self._images(f"{data}/attempt={c.attempt}")]
        fields = [f for f in layout.schema if f.name != EVENTS]
        if paths:
            rows = self.spark.read.schema(StructType(fields)).option("basePath", data).parquet(*paths)
        else:
            rows = self.spark.createDataFrame([], StructType(fields)).selectExpr("*", "'' AS attempt", f"'' AS {KIND}")
        names = [fx.quoted(f.name) for f in fields]
        change = f"if({KIND} = '{STATE}', 'insert', {KIND}) AS {CHANGE_TYPE}"
        rows = rows.selectExpr(*names, change, "attempt AS __attempt")
        times = self.spark.createDataFrame(
            [(c.attempt, c.version, c.committed_at) for c in commits],
            f"__attempt string, {COMMIT_VERSION} bigint, {COMMIT_TIME} timestamp",
        )
        return rows.join(F.broadcast(times), "__attempt").drop("__attempt")

    def _images(self, attempt: str) -> list[str]:
        """The folders that hold a commit's row images: its state rows, if it has written nothing else."""
        kinds = [k for k in subfolders(self.spark, attempt) if k.startswith(f"{KIND}=")]
        state = f"{KIND}={STATE}"
        return [f"{attempt}/{k}" for k in kinds if k != state or kinds == [state]]

    def net_changes(self, since: int = 1, until: int | None = None) -> DataFrame:
        """What versions ``since..until`` together changed: for a consumer that lags by several commits."""
        return net_changes(self.changes(since, until), self.keys)

    def follow(
        self, handle: Callable[[DataFrame, int], None], checkpoint: str, *, trigger: Mapping | None = None
    ) -> StreamingQuery:
        """Stream the change feed: every commit, once published, is given to ``handle(changes, version)`` in order.

        The stream reads the manifests, so files of a commit that died are never seen. A restart repeats at most the
        versions of one batch; ``handle`` should therefore be idempotent by version, as with any ``foreachBatch``.
        """
        manifests = self.spark.readStream.schema(MANIFEST).json(f"{self.root}/manifest")

        def deliver(batch: DataFrame, _: int) -> None:
            table = self.using(batch.sparkSession)
            for row in batch.where("events > 0").select("version").orderBy("version").collect():  # new commits only
                handle(table.changes(since=row.version, until=row.version), row.version)

        writer = manifests.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def rejects(self) -> DataFrame:
        """All rejected events of published commits, as the commits wrote them, with the ``version`` of each."""
        layout = self.layout()
        rejecting = self.commits().where("rejected > 0").select("attempt", "version").collect()
        if rejecting:
            base = f"{self.root}/rejects"
            reader = self.spark.read.schema(layout.reject_schema).option("basePath", base)
            rows = reader.parquet(*[f"{base}/attempt={r.attempt}" for r in rejecting])
            commits = self.spark.createDataFrame([tuple(r) for r in rejecting], "attempt string, version int")
            return rows.join(F.broadcast(commits), "attempt").drop("attempt")
        fields = [f for f in layout.schema if f.name != EVENTS] if layout.schema else []
        return self.spark.createDataFrame([], StructType(fields)).withColumn("version", F.lit(0))

    # ---- writing

    def merge(self, events: DataFrame, *, writer: str = "", epoch: int = 0) -> int:
        """Upsert change events and commit; returns the version that holds them.

        With a ``writer``, epochs at or below its last one are skipped. The events are read more than once; they are
        not cached, since a first load may be larger than all disks: what is worth keeping, the caller persists.
        """
        layout = self.layout()
        if writer and layout.epochs.get(writer, -1) >= epoch:
            return layout.version
        return self._commit(events, layout, {writer: epoch} if writer else {})

    def _commit(self, events: DataFrame, layout: Layout, epochs: dict[str, int]) -> int:
        version = layout.version + 1
        attempt = f"v{version}-{uuid.uuid4().hex}"
        if layout.schema:
            layout = replace(layout, schema=widened(layout.schema, events.schema, self.keys))
            events = as_stored(events, layout.schema)
        # one scan tells which buckets are touched, what is rejected and whether any key can be hot at all: a bucket is
        # so many hash slots, and no key has more events than its slot
        slots = self.buckets * max(1, HOT_SLOTS // self.buckets)
        per_slot = events.selectExpr(f"{fx.key_slot(self.keys, slots)} AS slot", SEQ).groupBy("slot")
        per_slot = per_slot.agg(F.expr(f"count({SEQ}) AS good"), F.expr(f"count_if({SEQ} IS NULL) AS bad"))
        per_bucket = per_slot.groupBy(F.expr(f"slot % {self.buckets}").alias("b"))
        per_bucket = per_bucket.agg(*[F.expr(e) for e in ("sum(good) AS good", "sum(bad) AS bad", "max(good) AS crowd")])
        counts = per_bucket.collect()  # at most one row per bucket
        touched = [r.b for r in counts if r.good]
        rejected = sum(r.bad for r in counts)

        ordered, rejects = split_rejects(events)
        reject_schema = layout.reject_schema
        if rejected:
            reject_schema = widened(reject_schema or rejects.schema, rejects.schema)
            known = set(reject_schema.names)
            reject_schema = StructType([*reject_schema, *[f for f in rejects.schema if f.name not in known]])
            as_stored(rejects, reject_schema).write.parquet(f"{self.root}/rejects/attempt={attempt}")
        schema, written = layout.schema, {"inserted": 0, "updated": 0}
        parts = rounds(counts, self.round_cells // len(events.columns))
        # a round that meets no old row may stand beside one that does
        together = {"fresh": layout.held_by.keys().isdisjoint(touched)} if len(parts) > 1 else {}
        for buckets, crowd in parts:
            some = ordered
            if len(parts) > 1:
                some = some.where(f"{self._bucket()} BETWEEN {buckets[0]} AND {buckets[-1]}")
            if self.hot_rows is not None and crowd > self.hot_rows:
                some = condense_hot_keys(some, self.keys, self.hot_rows)
            schema, added = self._write(some, layout, buckets, attempt, **together)
            written = {c: n + added[c] for c, n in written.items()}

        commit = {"events": sum(r.good for r in counts), "rejected": rejected, **written}
        totals = {"commits": layout.totals["commits"] + 1} | {c: layout.totals[c] + commit[c] for c in COUNTS}
        held_by = layout.held_by | dict.fromkeys(touched, attempt)
        manifest = commit | {
            "version": version,
            "attempt": attempt,
            "committed_at": datetime.now(timezone.utc).isoformat(timespec="microseconds"),
            "rows": layout.rows + written["inserted"],
            "bucket_count": self.buckets,
            "held_by": {str(b): a for b, a in held_by.items()},
            "epochs": layout.epochs | epochs,
            "row_schema": schema.json() if schema else None,
            "reject_schema": reject_schema.json() if reject_schema else None,
            "totals": totals,
        }
        try:
            publish_text(self.spark, self._manifest(version), json.dumps(manifest))
        except FileExistsError as error:
            for part in ("data", "rejects"):  # nobody refers to them
                remove(self.spark, f"{self.root}/{part}/attempt={attempt}")
            raise ConcurrentCommit(f"{self.root}: another writer has published version {version}") from error
        return version

    def _write(self, events: DataFrame, layout: Layout, touched: list[int], attempt: str, fresh: bool | None = None):
        """Merge and write; returns the table's schema from now on, old columns and new ones, and the counts. A commit
        is ``fresh`` if none of its rounds meets an old row."""
        old = self._rows(layout, touched)
        rows = absorb(
            old,
            events,
            self.keys,
            bucket=self._bucket(),
            splits=self.splits,
            partitions=len(touched) * self.splits,
            every_bucket=len(touched) == max(touched) - min(touched) + 1,
            stored=layout.schema,
            track_changes=self.track_changes,
        )
        counted, data = Observation(), f"{self.root}/data/attempt={attempt}"
        if old is None and fresh is not False:  # every row is new and its own image, so it is written once
            out = rows.drop(CHANGE, BEFORE).observe(counted, F.expr("count(1) AS inserted"), F.expr("0L AS updated"))
            out.write.mode("append").partitionBy(BUCKET).parquet(f"{data}/{KIND}={STATE}")
        else:
            out = images(rows, self.keys)
            out = out.observe(
                counted,
                F.expr(f"count_if({KIND} = 'insert') AS inserted"),
                F.expr(f"count_if({KIND} = 'update_postimage') AS updated"),
            )
            out.write.mode("append").partitionBy(KIND, BUCKET).parquet(data)
        return StructType([f for f in out.schema if f.name not in (KIND, BUCKET)]), counted.get


def rounds(counts: Sequence, most: int) -> list[tuple[list[int], int]]:
    """The buckets with events, in order and in rounds of at most ``most`` events, and the largest slot of each round.
    A bucket with more is a round of its own."""
    found: list[tuple[list[int], int]] = []
    room = 0
    for r in sorted((r for r in counts if r.good), key=lambda r: r.b):
        if not found or r.good > room:
            found.append(([], 0))
            room = most
        room -= r.good
        buckets, crowd = found[-1]
        found[-1] = ([*buckets, r.b], max(crowd, r.crowd))
    return found
