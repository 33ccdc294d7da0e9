"""Run entities as streaming queries: two feeds in, one keyed target out."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from siltline.functions.columns import quoted, text
from siltline.operators.conform import change_events
from siltline.operators.state import BUCKET, EVENTS
from siltline.plans.spec import EntitySpec
from siltline.sources.feeds import FeedNames, table_feed
from siltline.streaming.target import COUNTS, KeyedTable

# Shuffle files go as soon as the write or count that made them is done, those of a micro-batch with it; otherwise they
# stay until the driver's garbage collector finds them, those of every entity side by side (since Spark 4.1)
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def upsert_stream(
    events: DataFrame, table: KeyedTable, checkpoint: str, *, name: str | None = None, trigger: Mapping | None = None
) -> StreamingQuery:
    """Start a query that merges every micro-batch of change events into ``table``.

    The default trigger takes everything available and stops. No watermark is set: an event of any age is merged.
    A restart from the checkpoint replays at most one micro-batch, which the table recognises by query and epoch.
    """
    started: dict[str, str] = {}

    def merge(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession  # the query's own copy of the session
        session.conf.set("spark.sql.adaptive.enabled", "true")  # streams start with it off; the merge is batch work
        if "id" not in started:
            # the query id survives restarts and changes with a new checkpoint
            started["id"] = session.read.json(f"{checkpoint}/metadata").first()["id"]
        table.using(session).merge(batch, writer=started["id"], epoch=epoch)

    writer = events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    spark = events.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")  # a query takes its copy of the session when it starts
    try:
        return writer.trigger(**(trigger or {"availableNow": True})).start()
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def start_entity(
    spec: EntitySpec,
    main: DataFrame,
    recon: DataFrame | None,
    table: KeyedTable,
    checkpoint: str,
    *,
    trigger: Mapping | None = None,
    **conform,
) -> StreamingQuery:
    """Start the one query of an entity. ``main`` and ``recon`` are streaming DataFrames of the bronze feeds."""
    events = change_events(spec, main, recon, **conform)
    return upsert_stream(events, table, checkpoint, name=spec.target, trigger=trigger)


def run(
    spark: SparkSession,
    specs: Iterable[EntitySpec],
    *,
    silver: str,
    feeds: FeedNames | None = None,
    streams: Mapping[str, tuple[DataFrame, DataFrame | None]] | None = None,
    options: Mapping | None = None,
    schema: str | None = None,
    buckets: int = 32,
    splits: int = 4,
    trigger: Mapping | None = None,
    at_once: int = 2,
    **conform,
) -> DataFrame:
    """One triggered update over all entities: start every query, wait for all, return counts per entity.

    Queries run in the order of ``specs``, ``at_once`` of them side by side: one alone leaves cores idle between its
    jobs, and each more holds the shuffle files of its merge. With a trigger that never ends all run.

    Feeds come from catalog tables (``feeds``, read with ``options`` such as ``maxFilesPerTrigger``, which bounds the
    micro-batches of a first load) or are given per entity name (``streams``). Targets and checkpoints live below
    ``silver``. All feeds are resolved before the first query starts, and if one cannot start, those already running
    are stopped. If a query fails later the others still finish; then the failure is raised.

    Each target is registered under its own name: as a table of the catalog schema ``schema``, which any session of
    that catalog can read, or without one as a temporary view.
    """
    silver = silver.rstrip("/")
    resolved = []
    for spec in specs:
        if streams and spec.name in streams:
            main, recon = streams[spec.name]
        elif feeds:
            main, recon = (table_feed(spark, n(spec), **(options or {})) for n in (feeds.main, feeds.recon))
        else:
            raise ValueError(f"no feed given for {spec.name}")
        table = KeyedTable(spark, f"{silver}/{spec.target}", spec.keys, buckets=buckets, splits=splits)
        resolved.append((spec, main, recon, table))

    running, failures = [], []

    def wait(spec, table, query) -> None:
        try:
            query.awaitTermination()
        except Exception as error:  # noqa: BLE001 - reported below, once every entity has finished
            failures.append((spec.name, error))

    if trigger and not {"availableNow", "once"} & set(trigger):
        at_once = len(resolved)
    at_once = max(1, at_once)
    try:
        for i, (spec, main, recon, table) in enumerate(resolved):
            if i >= at_once:
                wait(*running[i - at_once])
            checkpoint = f"{silver}/checkpoints/{spec.target}"
            query = start_entity(spec, main, recon, table, checkpoint, trigger=trigger, **conform)
            running.append((spec, table, query))
    except BaseException:
        for _, _, query in running:
            query.stop()
        raise

    for started in running[-at_once:]:
        wait(*started)

    counts = []
    for spec, table, _ in running:
        layout = table.layout()  # one small file, however many commits there were
        if layout.held_by:
            if schema:
                publish(table, f"{schema}.{spec.target}")
            else:
                table.read().createOrReplaceTempView(spec.target)
        if layout.version:
            counts.append((spec.target, layout.rows, *(layout.totals[c] for c in (*COUNTS, "commits"))))
    if failures:
        names = ", ".join(name for name, _ in failures)
        raise RuntimeError(f"entities failed: {names}") from failures[0][1]
    return spark.createDataFrame(counts, f"target string, rows bigint, {', '.join(f'{c} bigint' for c in COUNTS)}, commits bigint")


def publish(table: KeyedTable, name: str) -> None:
    """Make the newest version readable as ``name`` in the catalog: a view over one external table per commit, whose
    partitions are the live bucket folders. The view is replaced in one step, so readers see one version or the next."""
    layout, spark = table.layout(), table.spark
    files = f"{name}_v{layout.version}"
    columns = [f for f in layout.schema if f.name != EVENTS]
    listed = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in columns)
    if not spark.catalog.tableExists(files):
        spark.sql(
            f"CREATE TABLE {files} ({listed}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET})"
            f" LOCATION {text(f'{table.root}/data')}"
        )
    paths = list(table.bucket_paths(layout).items())
    for at in range(0, len(paths), 100):
        added = " ".join(f"PARTITION ({BUCKET} = {b}) LOCATION {text(p)}" for b, p in paths[at : at + 100])
        spark.sql(f"ALTER TABLE {files} ADD IF NOT EXISTS {added}")
    names = ", ".join(quoted(f.name) for f in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {names} FROM {files}")
    # the last but one stays for readers that have just resolved the view; older ones are few, whatever the version is
    schema, _, bare = name.rpartition(".")
    listed = spark.sql(f"SHOW TABLES IN {schema} LIKE {text(f'{bare}_v*')}" if schema else f"SHOW TABLES LIKE {text(f'{bare}_v*')}")
    tables = [r.tableName for r in listed.collect() if r.tableName.removeprefix(f"{bare}_v".lower()).isdigit()]
    for old in sorted(tables, key=lambda t: int(t.rpartition("_v")[2]))[:-2]:
        spark.sql(f"DROP TABLE IF EXISTS {f'{schema}.' if schema else ''}{old}")
