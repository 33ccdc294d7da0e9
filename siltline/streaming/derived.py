"""An aggregate over a keyed table that is kept up to date from its change feed, without reading the table again."""

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltline.functions import columns as fx
from siltline.operators.changes import aggregate_delta, applied
from siltline.sources.workspace import files_in, publish_text, read_text
from siltline.streaming.target import KeyedTable


class KeptAggregate:
    """Rows and sums per group of ``table``, as of some commit of it.

    ``groups`` are columns of the table. ``sums`` maps names to expressions over a row; integers and decimals stay exact,
    sums of doubles gather rounding errors over many commits. A :meth:`refresh` reads the change images of the commits
    since the last one, and the totals so far. Its result is a folder of its own below ``root`` and becomes visible when
    a small file with the table's version does; of two that race for a version both found the same.
    """

    def __init__(self, table: KeyedTable, root: str, groups: Sequence[str], sums: Mapping[str, str] | None = None):
        self.table, self.root = table, root.rstrip("/")
        self.groups, self.sums = tuple(groups), dict(sums or {})

    def versions(self) -> list[int]:
        """The versions of the table for which totals are kept."""
        names = files_in(self.table.spark, f"{self.root}/totals")
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def _note(self, version: int) -> str:
        return f"{self.root}/totals/{version:012d}.json"

    def read(self, version: int | None = None) -> DataFrame:
        """``groups, rows, sums`` as of a kept version, by default the newest. Groups without rows are not there."""
        kept = self.versions()
        if not kept:
            raise ValueError(f"{self.root} has not been refreshed yet")
        note = json.loads(read_text(self.table.spark, self._note(kept[-1] if version is None else version)))
        schema = StructType.fromJson(json.loads(note["schema"]))
        return self.table.spark.read.schema(schema).parquet(f"{self.root}/data/{note['folder']}")

    def refresh(self, until: int | None = None) -> int:
        """Bring the totals up to the table's newest commit, or to ``until``; returns the version they are of."""
        kept, committed = self.versions(), self.table.versions()
        since = kept[-1] if kept else 0
        until = min(until or committed[-1], committed[-1]) if committed else 0
        if until <= since:
            return since
        totals = aggregate_delta(self.table.changes(since + 1, until), self.groups, self.sums)
        if kept:
            totals = applied(self.read(since), totals, self.groups, self.sums)
        else:
            totals = totals.where("rows <> 0")
        # a sum of sums would grow its type with every refresh; groups take the type that the table has by now
        kinds = {f.name: f.dataType for f in totals.schema}
        if kept:
            kinds |= {f.name: f.dataType for f in self.read(since).schema if f.name not in self.groups}
        totals = totals.select(*[F.col(fx.quoted(n)).cast(t).alias(n) for n, t in kinds.items()])
        folder = f"v{until}-{uuid.uuid4().hex}"
        totals.write.parquet(f"{self.root}/data/{folder}")
        try:
            publish_text(
                self.table.spark, self._note(until), json.dumps({"folder": folder, "schema": totals.schema.json()})
            )
        except FileExistsError:
            pass  # another refresh has found the same
        return until
