"""Hand-over from a first bulk load to the stream: one batch over a recorded list of files, then exactly the rest.

A feed's first load may be most of the data it will ever hold. As a batch over files it is planned like any query: the
pass that counts reads the key columns only, and hot keys are found before the shuffle. A micro-batch offers neither.
"""

import json
import re
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from siltline.functions.columns import text
from siltline.operators.conform import change_events
from siltline.plans.spec import EntitySpec
from siltline.sources.feeds import folder_feed
from siltline.sources.workspace import files_in, publish_text, read_text
from siltline.streaming.runner import start_entity
from siltline.streaming.target import KeyedTable

FIRST_LOAD = "first load"


class SplitFeed:
    """A folder of Parquet files, split into those of the first load and all that come later.

    The list is recorded in ``note`` when it is first asked for, and never changes; of two that record at once both use
    the list of the first. It is held by the driver, as Spark's own listing of the folder is: some 100 bytes a file.
    """

    def __init__(self, spark: SparkSession, path: str, note: str, schema: StructType | str | None = None):
        self.spark, self.path, self.note = spark, path, note
        self.schema = schema or spark.read.parquet(path).schema

    def files(self) -> list[str]:
        """The files of the first load, named as ``_metadata.file_path`` names them."""
        folder, _, name = self.note.rpartition("/")
        if name not in files_in(self.spark, folder):
            found = self.spark.read.schema(self.schema).parquet(self.path).inputFiles()
            names = sorted(re.sub("^file:/+", "file:/", f) for f in found)
            try:
                publish_text(self.spark, self.note, json.dumps(names))
            except FileExistsError:
                pass
        return json.loads(read_text(self.spark, self.note))

    def batch(self) -> DataFrame:
        """The first load."""
        files = self.files()
        if not files:
            return self.spark.read.schema(self.schema).parquet(self.path).where("false")
        # names are percent-encoded; a reader wants them plain, with what it would take for a pattern escaped
        return self.spark.read.schema(self.schema).parquet(*[re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(f)) for f in files])

    def stream(self, files_per_trigger: int | None = None) -> DataFrame:
        """Every other file. Files of the first load are left out by name when a trigger plans its scan, unread."""
        feed = folder_feed(self.spark, self.path, schema=self.schema, files_per_trigger=files_per_trigger)
        files = self.files()
        return feed.where(f"_metadata.file_path NOT IN ({', '.join(map(text, files))})") if files else feed


def load_then_stream(
    spec: EntitySpec,
    main: SplitFeed,
    recon: SplitFeed | None,
    table: KeyedTable,
    checkpoint: str,
    *,
    files_per_trigger: int | None = None,
    trigger: Mapping | None = None,
    **conform,
) -> StreamingQuery:
    """Merge the first load of both feeds as one commit, then start the stream over all other files.

    May be stopped anywhere and called again: the lists are recorded before anything is merged, and the table knows
    whether it holds the first load, so no event is lost or merged twice.
    """
    if FIRST_LOAD not in table.layout().epochs:
        events = change_events(spec, main.batch(), recon.batch() if recon else None, **conform)
        table.merge(events, writer=FIRST_LOAD, epoch=0)
    streams = [f.stream(files_per_trigger) if f else None for f in (main, recon)]
    return start_entity(spec, *streams, table, checkpoint, trigger=trigger, **conform)
