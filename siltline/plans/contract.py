"""Contract queries: every operator run over the given tables, one named query each.

The bronze feeds are derived from ``events`` (and other tables) by fixed arithmetic, so that the same feed can be
written down in plain SQL and the results compared. Nothing here samples or caps a table.
"""

from collections.abc import Callable
from dataclasses import replace
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from siltline.functions import columns as fx
from siltline.operators.changes import CHANGE_TYPE, change_feed
from siltline.operators.conform import (
    MAIN,
    RECON,
    as_events,
    cast_failures,
    change_events,
    conform_main,
    conform_recon,
    recon_from_snapshots,
)
from siltline.operators.upsert import ORDER, current, folded, split_rejects, upsert
from siltline.plans.derived import (
    entity_feed,
    entity_recon_feed,
    entity_streams,
    main_feed,
    recon_feed,
    table,
)
from siltline.plans.entities import ENTITIES, WORK_PACKAGE_WORKFLOW_LISTS
from siltline.plans.spec import EntitySpec, Source
from siltline.session import tuned
from siltline.sources.feeds import folder_feed
from siltline.sources.workspace import scratch
from siltline.streaming.derived import KeptAggregate
from siltline.streaming.handover import SplitFeed, load_then_stream
from siltline.streaming.runner import run, start_entity
from siltline.streaming.statestore import RowLog, upsert_in_state
from siltline.streaming.target import KeyedTable

Query = Callable[[SparkSession, str], DataFrame]

# fixed load literals, so that results do not depend on who runs a query and when
LOAD = {"load_user": "loader", "load_time": "2024-01-15 00:00:00"}
TIE = "event_id"

ACTIVITY = EntitySpec(
    name="activity",
    keys=("EVENT_TYPE", "USER_ID"),
    columns=(Source("event_type"), Source("user_id"), Source("val"), Source("props"), Source("dtRemoved")),
)
ACTIVITY3 = replace(
    ACTIVITY, keys=("EVENT_TYPE", "USER_ID", "PART"), columns=(*ACTIVITY.columns, Source("part"))
)
MEASURED = replace(
    ACTIVITY, columns=(*ACTIVITY.columns, Source("hours", cast="double"), Source("code", cast="bigint"))
)
WEEKS = ("2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00")
SHOWN = ("VAL", "PROPS", "ACTIVE_FLAG", "DT_REMOVED", "_ingested_at")


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps without zone and decimals as exact text, so that any client shows the same values."""
    out = []
    for field in df.schema.fields:
        value = fx.quoted(field.name)
        if isinstance(field.dataType, TimestampType):
            value = fx.convert(value, "timestamp_ntz")
        elif isinstance(field.dataType, DecimalType):
            value = fx.convert(value, "string")
        out.append(fx.aliased(value, field.name))
    return df.selectExpr(*out)


def activity_events(spark, sf, spec=ACTIVITY, recon=True, main=True):
    bronze = main_feed(spark, sf)
    feed = recon_feed(spark, sf) if recon else None
    events = change_events(spec, bronze, feed, tie=TIE, **LOAD)
    return events if main else events.where(F.col("__flow") == RECON)


def width(spark) -> int:
    """Buckets and staged files: as many as the session shuffles into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shown(df, spec=ACTIVITY, columns=SHOWN):
    return comparable(df.select(*spec.keys, *columns))


# ---- conform


def cast_double(spark, sf):
    o = table(spark, sf, "orders")
    return o.selectExpr("o_orderkey", fx.convert("o_orderkey || '.25'", "double") + " AS manhours")


def cast_decimal(spark, sf):
    o = table(spark, sf, "orders")
    price = fx.convert("(o_orderkey + 1) || '.125'", "decimal(38,12)")
    return comparable(o.selectExpr("o_orderkey", f"{price} AS list_price"))


def cast_bigint(spark, sf):
    li = table(spark, sf, "lineitem")
    order = fx.convert("cast(l_orderkey * 10 + l_linenumber AS string)", "bigint")
    return li.selectExpr("l_orderkey", "l_linenumber", f"{order} AS order_sequence")


def cast_or_null(spark, sf):
    hours = fx.convert("if(event_id % 4 = 0, 'n/a', cast(event_id AS string))", "double", on_error="null")
    return table(spark, sf, "events").selectExpr("event_id", f"{hours} AS manhours")


def cast_failures_query(spark, sf):
    """What blanking malformed values would lose, per cast column."""
    return cast_failures(malformed_feed(spark, sf), MEASURED)


def malformed_feed(spark, sf):
    return main_feed(spark, sf).selectExpr(
        "*", "if(event_id % 4 = 0, 'n/a', cast(event_id AS string)) AS hours",
        "if(event_id % 7 = 0, event_id || '-x', cast(event_id AS string)) AS code",
    )


def cast_rejects(spark, sf):
    """Events with malformed values, and events without a sequence, each with the columns that are at fault."""
    spec = replace(MEASURED, sequence=("RecordLastModified",))
    events = change_events(spec, malformed_feed(spark, sf), on_cast_error="reject", tie=TIE, **LOAD)
    _, rejects = split_rejects(events)
    return rejects.select(F.col("__tie").alias(TIE), F.array_join("reject_reasons", ",").alias("reasons"))


def upsert_without_rejects(spark, sf):
    """What is left of the same feed, merged: values are cast, and no row has lost one."""
    events = change_events(MEASURED, malformed_feed(spark, sf), on_cast_error="reject", tie=TIE, **LOAD)
    return shown(upsert(events, MEASURED.keys), MEASURED, ("HOURS", "CODE", "VAL"))


def recon_from_snapshots_query(spark, sf):
    """Keys seen in the first half of January and not in the second are removed, and merged like any reconciliation."""
    feed = main_feed(spark, sf)
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp")
    before, after = feed.where(F.col("_ingested_at") < cut), feed.where(F.col("_ingested_at") >= cut)
    recon = recon_from_snapshots(before, after, ACTIVITY3, taken_at="2024-02-01 00:00:00").withColumn(TIE, F.lit(0))
    return shown(upsert(change_events(ACTIVITY3, feed, recon, tie=TIE, **LOAD), ACTIVITY3.keys), ACTIVITY3)


def soft_delete(spark, sf):
    return main_feed(spark, sf).selectExpr(TIE, f"{fx.soft_delete_flag('dtRemoved')} AS active_flag")


def hard_delete(spark, sf):
    return recon_feed(spark, sf).selectExpr(TIE, f"{fx.hard_delete_flag('hard_delete')} AS active_flag")


def seq2(spark, sf):
    sequence = fx.first_known(["RecordLastModified", "_ingested_at"])
    return comparable(main_feed(spark, sf).selectExpr(TIE, f"{sequence} AS seq"))


def seq3(spark, sf):
    sequence = fx.first_known(["StateDate", "ResourceStateDate", "_ingested_at"])
    return comparable(main_feed(spark, sf).selectExpr(TIE, f"{sequence} AS seq"))


def conform_query(spec) -> Query:
    def query(spark, sf):
        return comparable(conform_main(entity_feed(spark, sf, spec), spec, carry=(TIE,), **LOAD))

    return query


def conform_recon_query(spec) -> Query:
    def query(spark, sf):
        view = conform_recon(entity_recon_feed(spark, sf, spec), spec, load_time=LOAD["load_time"], carry=(TIE,))
        return comparable(view)

    return query


# ---- upsert


def entity_query(spec) -> Query:
    def query(spark, sf):
        events = change_events(
            spec, entity_feed(spark, sf, spec), entity_recon_feed(spark, sf, spec), tie=TIE, **LOAD
        )
        return comparable(upsert(events, spec.keys))

    return query


def upsert_latest(spark, sf):
    return shown(upsert(activity_events(spark, sf, recon=False), ACTIVITY.keys))


def upsert_three_keys(spark, sf):
    return shown(upsert(activity_events(spark, sf, ACTIVITY3, recon=False), ACTIVITY3.keys), ACTIVITY3)


def upsert_ignore_nulls(spark, sf):
    events = activity_events(spark, sf, recon=False)
    return upsert(events, ACTIVITY.keys).select(*ACTIVITY.keys, "VAL", "PROPS")


def upsert_out_of_order(spark, sf):
    """The feed arrives newest first and in three separate merges; the result is that of one ordered pass."""
    events = activity_events(spark, sf, recon=False)
    target = KeyedTable(spark, scratch(spark, "late"), ACTIVITY.keys, buckets=width(spark), splits=1)
    batch = F.pmod(F.xxhash64("__tie"), F.lit(3))
    for part in (2, 0, 1):
        target.merge(events.where(batch == part))
    return shown(target.read())


def upsert_processing_time_ties(spark, sf):
    """Sequence is one constant for all events, so arrival and the tie-break decide."""
    spec = replace(ACTIVITY, sequence=())
    return shown(upsert(activity_events(spark, sf, spec), spec.keys))


def two_flow_upsert(spark, sf):
    return shown(upsert(activity_events(spark, sf), ACTIVITY.keys))


def upsert_hot_keys(spark, sf):
    """Five keys share all rows of both feeds; each is above the limit and is condensed in parts first."""
    spec = replace(ACTIVITY, keys=("EVENT_TYPE",))
    return shown(upsert(activity_events(spark, sf, spec), spec.keys, hot_rows=500, fold_columns=0), spec)


def upsert_map_side(spark, sf):
    """The same keys by one aggregate that combines before its shuffle, without looking for hot keys."""
    spec = replace(ACTIVITY, keys=("EVENT_TYPE",))
    return shown(folded(activity_events(spark, sf, spec), spec.keys), spec)


def upsert_default_tie(spark, sf):
    """The tie-break is left at its default, a hash of the row; arrival is unique here, so it is never decisive."""
    feed = main_feed(spark, sf).select(*["event_type", "user_id", "val", "props", "_ingested_at", "event_id"])
    events = as_events(feed, sequence="_ingested_at", flow=MAIN, arrival="event_id", exclude=("event_id",))
    return comparable(upsert(events, ["event_type", "user_id"]))


def table_schema_growth(spark, sf):
    """Producers without, with and again without a column: no commit loses the column or its values."""
    events = activity_events(spark, sf, recon=False)
    target = KeyedTable(spark, scratch(spark, "growth"), ACTIVITY.keys, buckets=2 * width(spark), splits=1)
    third = F.pmod(F.col("__tie"), F.lit(3))
    for part in (0, 1, 2):
        batch = events.where(third == part)
        target.merge(batch if part == 1 else batch.drop("PROPS"))
    return shown(target.read())


GROWING = replace(ACTIVITY, columns=(*ACTIVITY.columns, Source("count"), Source("ratio"), Source("price")))
GROWN = ("COUNT", "RATIO", "PRICE", "PROPS", "ACTIVE_FLAG")


def table_type_growth(spark, sf):
    """A feed whose columns grow from int to bigint, float to double and to longer decimals, shrink again, and go."""
    feed = main_feed(spark, sf)
    ratio = "cast(user_id AS float) / 7"
    parts = (
        ("cast(event_id % 1000000 AS int)", f"cast({ratio} AS float)", "cast(event_id % 1000 + 0.25 AS decimal(6,2))"),
        ("event_id + 5000000000", "cast(user_id AS double) / 8", "cast(event_id % 100000 + 0.0625 AS decimal(12,4))"),
        ("cast(event_id % 100 AS smallint)", f"cast({ratio} AS float)", None),
    )
    target = KeyedTable(spark, scratch(spark, "growing"), GROWING.keys, buckets=width(spark), splits=1)
    for i, (count, ratio, price) in enumerate(parts):
        part = feed.where(f"event_id % 3 = {i}").selectExpr("*", f"{count} AS count", f"{ratio} AS ratio")
        part = part.selectExpr("*", f"{price} AS price") if price else part.drop("props")
        target.merge(change_events(GROWING, part, absent="null", tie=TIE, **LOAD))
    return shown(target.read(), GROWING, GROWN)


def recon_stub_rows(spark, sf):
    """Reconciliation rows for users the main feed never mentions."""
    strangers = recon_feed(spark, sf).withColumn("user_id", F.col("user_id") + 100000)
    events = change_events(ACTIVITY, main_feed(spark, sf), strangers, tie=TIE, **LOAD)
    return shown(upsert(events, ACTIVITY.keys))


def reactivation_sticky_removed(spark, sf):
    rows = shown(upsert(activity_events(spark, sf), ACTIVITY.keys))
    return rows.where(F.col("ACTIVE_FLAG") & F.col("DT_REMOVED").isNotNull())


def main_behind_recon(spark, sf):
    """Keys whose newest event is a reconciliation row; their business columns still come from the main feed. One
    event in four gives a reconciliation row here, so for other keys the newest event is a main one, or the only."""
    recon = recon_feed(spark, sf).where("event_id % 4 = 0")
    events = change_events(ACTIVITY, main_feed(spark, sf), recon, tie=TIE, **LOAD)
    newest = F.max(F.struct("__seq", "__flow"))["__flow"]
    behind = events.groupBy(*ACTIVITY.keys).agg(newest.alias("last_flow")).where(F.col("last_flow") == RECON)
    rows = upsert(events, ACTIVITY.keys).join(behind.drop("last_flow"), list(ACTIVITY.keys), "left_semi")
    return shown(rows)


def workflow_only_recon_deactivates(spark, sf):
    spec = WORK_PACKAGE_WORKFLOW_LISTS
    events = change_events(
        spec, entity_feed(spark, sf, spec), entity_recon_feed(spark, sf, spec), tie=TIE, **LOAD
    )
    rows = upsert(events, spec.keys).where(~F.col("ACTIVE_FLAG"))
    return comparable(rows.select(*spec.keys, "PROJECT", "ACTIVE_FLAG", "DT_REMOVED"))


def except_columns(spark, sf):
    """Only the names of the target: the excluded columns ordered the events but are gone."""
    rows = upsert(activity_events(spark, sf), ACTIVITY.keys)
    counts = rows.agg(*[F.count(F.col(c)).alias(c) for c in rows.columns])  # one row
    named = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("known_rows")) for c in rows.columns])
    return counts.select(F.inline(named))


def null_sequence_rejects(spark, sf):
    spec = replace(ACTIVITY, sequence=("RecordLastModified",))
    _, rejects = split_rejects(change_events(spec, main_feed(spark, sf), tie=TIE, **LOAD))
    return rejects.select(*spec.keys, F.col("__tie").alias(TIE))


def conversation_latest(spark, sf):
    turns = table(spark, sf, "conversations").withColumn("t", F.col("turn"))
    events = as_events(turns, sequence="turn", flow=MAIN, arrival="turn", tie="t")
    return upsert(events, ["conv_id"])


def document_latest(spark, sf):
    """Whole texts under few, very large keys: the latest document per language and source."""
    docs = table(spark, sf, "documents").withColumn("t", F.col("doc_id"))
    events = as_events(docs, sequence="doc_id", flow=MAIN, arrival="doc_id", tie="t")
    return upsert(events, ["lang", "source"])


def line_latest(spark, sf):
    """Order lines by ship date; the key repeats, so later ship dates win and equal ones tie on the part."""
    lines = table(spark, sf, "lineitem").withColumn("t", F.col("l_partkey") * 1000000 + F.col("l_suppkey"))
    lines = lines.withColumn("price_tie", F.floor(F.col("l_extendedprice") * 100))
    events = as_events(lines, sequence="l_shipdate", flow=MAIN, arrival="price_tie", exclude=("price_tie",), tie="t")
    return comparable(upsert(events, ["l_orderkey", "l_linenumber"]))


def customer_latest_order(spark, sf):
    orders = table(spark, sf, "orders").withColumn("t", F.col("o_orderkey"))
    events = as_events(orders, sequence="o_orderdate", flow=MAIN, arrival="o_orderdate", tie="t")
    return comparable(upsert(events, ["o_custkey"]))


# ---- change feed, tables, streams


def change_feed_query(spark, sf):
    """What the second half of January changed."""
    events = activity_events(spark, sf)
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp")
    old = current(events.where(F.col("__arrival") < cut), ACTIVITY.keys)
    new = current(events, ACTIVITY.keys)
    kept = [*ACTIVITY.keys, "VAL", "ACTIVE_FLAG", "DT_REMOVED"]
    return comparable(change_feed(old.select(*kept), new.select(*kept), ACTIVITY.keys))


def two_commits(spark, sf, root: str) -> KeyedTable:
    """A keyed table that took the first half of January, then the second."""
    events = activity_events(spark, sf)
    kept = events.select(*ACTIVITY.keys, "VAL", "ACTIVE_FLAG", "DT_REMOVED", *ORDER)
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp")
    target = KeyedTable(spark, root, ACTIVITY.keys, buckets=width(spark), splits=1)
    target.merge(kept.where(F.col("__arrival") < cut))
    target.merge(kept.where(F.col("__arrival") >= cut))
    return target


def table_change_feed(spark, sf):
    """The same, taken from the files a keyed table wrote in its second commit."""
    rows = two_commits(spark, sf, scratch(spark, "feed")).changes(since=2)
    return comparable(rows.select(*ACTIVITY.keys, "VAL", "ACTIVE_FLAG", "DT_REMOVED", CHANGE_TYPE))


def weekly_commits(spark, sf, root: str, after_commit=lambda table: None) -> KeyedTable:
    """A keyed table that took January in four commits, week by week of arrival."""
    events = activity_events(spark, sf).select(*ACTIVITY.keys, "VAL", "ACTIVE_FLAG", "DT_REMOVED", *ORDER)
    target = KeyedTable(spark, root, ACTIVITY.keys, buckets=width(spark), splits=1)
    arrival = F.col("__arrival")
    for start, end in zip((None, *WEEKS), (*WEEKS, None), strict=True):
        batch = events if start is None else events.where(arrival >= F.lit(start).cast("timestamp"))
        target.merge(batch if end is None else batch.where(arrival < F.lit(end).cast("timestamp")))
        after_commit(target)
    return target


def net_change_feed(spark, sf):
    """What the last three of four commits amount to for a consumer that has seen the first."""
    rows = weekly_commits(spark, sf, scratch(spark, "net")).net_changes(since=2)
    return comparable(rows.select(*ACTIVITY.keys, "VAL", "ACTIVE_FLAG", "DT_REMOVED", CHANGE_TYPE))


def active_rows_by_type(spark, sf):
    """Counts and sums per event type and flag, kept from the change feed, as they were after each of four commits."""
    root = scratch(spark, "kept")
    groups, sums = ("EVENT_TYPE", "ACTIVE_FLAG"), {"removed": "if(DT_REMOVED IS NULL, 0L, 1L)", "user_sum": "USER_ID"}
    kept = None

    def refresh(table):
        nonlocal kept
        kept = KeptAggregate(table, f"{root}/totals", groups, sums)
        kept.refresh()

    weekly_commits(spark, sf, f"{root}/table", refresh)
    parts = [kept.read(v).withColumn("commit", F.lit(v).cast("bigint")) for v in kept.versions()]
    return reduce(DataFrame.unionByName, parts)


def stream_change_feed(spark, sf):
    """The same again, followed by a streaming query that writes down each commit's changes."""
    root = scratch(spark, "followed")
    target = two_commits(spark, sf, f"{root}/table")

    def write(changes: DataFrame, version: int) -> None:
        changes.write.mode("overwrite").parquet(f"{root}/seen/commit={version}")

    target.follow(write, f"{root}/checkpoint").awaitTermination()
    rows = spark.read.parquet(f"{root}/seen").where("commit = 2")
    return comparable(rows.select(*ACTIVITY.keys, "VAL", "ACTIVE_FLAG", "DT_REMOVED", CHANGE_TYPE))


def stage(feed: DataFrame, path: str, files: int, mode: str = "errorifexists") -> None:
    """Write a feed as ``files`` Parquet files, dealt by hash."""
    feed.repartition(files, F.xxhash64(TIE)).write.mode(mode).parquet(path)


def stream_two_flow_upsert(spark, sf):
    """Both feeds as files, merged by a streaming query into a keyed table in two or more micro-batches."""
    root, files = scratch(spark, "stream"), max(2, width(spark))
    feeds = {"main": main_feed(spark, sf), "recon": recon_feed(spark, sf)}
    for name, feed in feeds.items():
        stage(feed, f"{root}/{name}", files)
    target = KeyedTable(spark, f"{root}/table", ACTIVITY.keys, buckets=width(spark), splits=1)
    streams = [folder_feed(spark, f"{root}/{name}", files_per_trigger=-(-files // 2)) for name in feeds]
    start_entity(ACTIVITY, *streams, target, f"{root}/checkpoint", tie=TIE, **LOAD).awaitTermination()
    return shown(target.read())


def state_store_upsert(spark, sf):
    """The same feeds, folded in the state store in two or more micro-batches."""
    root, files = scratch(spark, "state"), max(2, width(spark))
    feeds = {"main": main_feed(spark, sf), "recon": recon_feed(spark, sf)}
    for name, feed in feeds.items():
        stage(feed, f"{root}/{name}", files)
    streams = [folder_feed(spark, f"{root}/{name}", files_per_trigger=-(-files // 2)) for name in feeds]
    log = RowLog(spark, f"{root}/log", ACTIVITY.keys)
    upsert_in_state(change_events(ACTIVITY, *streams, tie=TIE, **LOAD), log, f"{root}/checkpoint").awaitTermination()
    return shown(log.read())


def hand_over_upsert(spark, sf):
    """The older part of both feeds as one batch, the rest as a stream over the same folders."""
    root, files = scratch(spark, "handover"), max(2, width(spark))
    feeds = {"main": main_feed(spark, sf), "recon": recon_feed(spark, sf)}
    halves = []
    for name, feed in feeds.items():
        stage(feed.where(f"{TIE} % 3 <> 0"), f"{root}/{name}", files)
        halves.append(SplitFeed(spark, f"{root}/{name}", f"{root}/first/{name}.json"))
        halves[-1].files()  # the list is recorded now: what follows is for the stream
        stage(feed.where(f"{TIE} % 3 = 0"), f"{root}/{name}", files, "append")
    target = KeyedTable(spark, f"{root}/table", ACTIVITY.keys, buckets=width(spark), splits=1)
    load_then_stream(ACTIVITY, *halves, target, f"{root}/checkpoint", tie=TIE, **LOAD).awaitTermination()
    return shown(target.read())


def stream_entity_query(spec) -> Query:
    """The entity as a stream: one triggered update from its two feeds, then the target's contents."""

    def query(spark, sf):
        silver = scratch(spark, "entity")
        streams = {spec.name: entity_streams(spark, sf, spec)}
        run(spark, [spec], streams=streams, silver=silver, buckets=width(spark), splits=1, tie=TIE, **LOAD)
        table = KeyedTable(spark, f"{silver}/{spec.target}", spec.keys, buckets=width(spark))
        return comparable(table.read().select(*spec.target_columns))

    return query


def pipeline_row_counts(spark, sf):
    """One triggered update over all eight entities, each from its two feeds."""
    streams = {spec.name: entity_streams(spark, sf, spec) for spec in ENTITIES}
    silver = scratch(spark, "run")
    counts = run(
        spark, ENTITIES, streams=streams, silver=silver, buckets=width(spark), splits=1, at_once=1, tie=TIE, **LOAD
    )
    return counts.select("target", "rows", "events", "rejected")


def in_tuned_session(query: Query) -> Query:
    @wraps(query)
    def run_query(spark, sf):
        return query(tuned(spark), sf)

    return run_query


def queries() -> dict[str, Query]:
    named = {
        "cast_double": cast_double,
        "cast_decimal_38_12": cast_decimal,
        "cast_bigint": cast_bigint,
        "cast_or_null": cast_or_null,
        "cast_failures": cast_failures_query,
        "cast_rejects": cast_rejects,
        "upsert_without_rejects": upsert_without_rejects,
        "recon_from_snapshots": recon_from_snapshots_query,
        "soft_delete_flag": soft_delete,
        "recon_flag": hard_delete,
        "seq_coalesce2": seq2,
        "seq_coalesce3": seq3,
        "upsert_latest": upsert_latest,
        "upsert_three_keys": upsert_three_keys,
        "upsert_ignore_nulls": upsert_ignore_nulls,
        "upsert_out_of_order": upsert_out_of_order,
        "upsert_processing_time_ties": upsert_processing_time_ties,
        "two_flow_upsert": two_flow_upsert,
        "upsert_hot_keys": upsert_hot_keys,
        "upsert_map_side": upsert_map_side,
        "upsert_default_tie": upsert_default_tie,
        "recon_stub_rows": recon_stub_rows,
        "reactivation_sticky_removed": reactivation_sticky_removed,
        "main_behind_recon": main_behind_recon,
        "workflow_only_recon_deactivates": workflow_only_recon_deactivates,
        "except_columns": except_columns,
        "change_feed": change_feed_query,
        "table_change_feed": table_change_feed,
        "stream_change_feed": stream_change_feed,
        "net_change_feed": net_change_feed,
        "active_rows_by_type": active_rows_by_type,
        "table_schema_growth": table_schema_growth,
        "table_type_growth": table_type_growth,
        "null_sequence_rejects": null_sequence_rejects,
        "conversation_latest": conversation_latest,
        "document_latest": document_latest,
        "line_latest": line_latest,
        "customer_latest_order": customer_latest_order,
        "stream_two_flow_upsert": stream_two_flow_upsert,
        "state_store_upsert": state_store_upsert,
        "hand_over_upsert": hand_over_upsert,
        "pipeline_row_counts": pipeline_row_counts,
    }
    for spec in ENTITIES:
        named[f"conform_{spec.name}"] = conform_query(spec)
        named[f"conform_recon_{spec.name}"] = conform_recon_query(spec)
        named[f"entity_{spec.name}"] = entity_query(spec)
        named[f"stream_{spec.name}"] = stream_entity_query(spec)
    return {name: in_tuned_session(query) for name, query in named.items()}
