"""Bronze feeds derived from the ``events`` table by fixed arithmetic.

Each feed is a list of ``(column, SQL text)`` over ``events``; only "this many seconds before ts" is written
differently in the checking engine, hence the ``back`` argument. Every event gives one main and one recon row.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.plans.spec import EntitySpec

Columns = list[tuple[str, str]]
Back = Callable[[str], str]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _before(seconds: str) -> str:
    return f"timestampadd(SECOND, -({seconds}), ts)"


def _derive(events: DataFrame, columns: Columns) -> DataFrame:
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return events.selectExpr(*[f"{sql} AS `{name}`" for name, sql in columns])


def _events(spark: SparkSession, sf_dir: str, columns: Columns) -> DataFrame:
    return _derive(table(spark, sf_dir, "events"), columns)


def spread(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Deal narrow rows to as many tasks as the session shuffles into, before they become some thirty times wider.

    A scan has at most one task per row group, and a file may be a single one.
    """
    return events.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def unless(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN NULL ELSE {value} END"


MODIFIED = "(event_id % 13) * 600"
DELETED = "event_id % 14 = 0"
REMOVED_AT = f"CASE WHEN {DELETED} THEN ts END"
HARD_DELETE = unless("event_id % 21 = 0", DELETED)


def main_columns(back: Back) -> Columns:
    return [
        ("event_type", "event_type"),
        ("user_id", "user_id"),
        ("part", "event_id % 4"),
        ("val", unless("event_id % 3 = 0", "value")),
        ("props", unless("event_id % 5 = 0", "props")),
        ("dtRemoved", "CASE WHEN event_id % 17 = 0 THEN ts END"),
        ("RecordLastModified", unless("event_id % 11 = 0", back(MODIFIED))),
        ("StateDate", unless("event_id % 2 = 0", back("(event_id % 5) * 60"))),
        ("ResourceStateDate", unless("event_id % 3 = 0", back("(event_id % 7) * 3600"))),
        ("_ingested_at", "ts"),
        ("_source_system", "'events'"),
        ("_source_table", "event_type"),
        ("event_id", "event_id"),
    ]


def recon_columns(keys: Columns) -> Columns:
    return [
        *keys,
        ("hard_delete", HARD_DELETE),
        ("dt_removed", REMOVED_AT),
        ("ingested_at", "ts"),
        ("event_id", "event_id"),
    ]


ACTIVITY_KEYS: Columns = [("event_type", "event_type"), ("user_id", "user_id"), ("part", "event_id % 4")]


def main_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, main_columns(_before))


def recon_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, recon_columns(ACTIVITY_KEYS))


# ---- feeds for the shipped entities: types by name, values by position


def kind(name: str, cast: str | None) -> str:
    """The type a bronze column is taken to have, by its name; columns that are cast arrive as text."""
    if cast:
        return "whole text" if cast == "bigint" else "decimal text"
    if name.endswith("Date") or name in ("RecordCreated", "RecordLastModified", "dtRemoved"):
        return "timestamp"
    if name.endswith(("Id", "ID", "Sequence")) or name == "Persons":
        return "bigint"
    if name.startswith(("Is", "Has", "Can", "Show", "Uses", "Ignore")):
        return "boolean"
    if any(part in name for part in ("itude", "Duration", "Manhours", "PctWeight", "LagOrLead")):
        return "double"
    return "string"


def _value(name: str, cast: str | None, i: int, back: Back) -> str:
    return {
        "whole text": "CAST(event_id % 997 AS STRING)",
        "decimal text": "CAST(event_id % 997 + 1 AS STRING) || '.25'",
        "timestamp": back(f"(event_id % {i + 7}) * 60"),
        "bigint": f"event_id * {i + 1} % 1009",
        "boolean": f"(event_id + {i}) % 2 = 0",
        "double": f"value * {i + 1}",
        "string": f"props || '-{i}-' || CAST(event_id % 50 AS STRING)",
    }[kind(name, cast)]


def key_columns(spec: EntitySpec) -> Columns:
    """Instance, then the user, then a small third part where the entity has three keys."""
    values = ["CAST(length(event_type) AS BIGINT)", "user_id", "event_id % 4"]
    order = sorted(spec.key_sources, key=lambda k: k.target not in ("INSTANCE",))
    return [(k.name, v) for k, v in zip(order, values, strict=False)]


def entity_columns(spec: EntitySpec, back: Back) -> Columns:
    fixed = dict(key_columns(spec))
    fixed |= {n: s for n, s in main_columns(back) if n in spec.source_columns}
    casts = {getattr(c, "name", None): c.cast for c in spec.columns}
    out = [
        (name, fixed.get(name) or unless(f"(event_id + {i}) % 3 = 0", _value(name, casts.get(name), i, back)))
        for i, name in enumerate(spec.source_columns)
    ]
    return [*out, ("event_id", "event_id")]


def entity_feed(spark: SparkSession, sf_dir: str, spec: EntitySpec) -> DataFrame:
    return _derive(spread(spark, table(spark, sf_dir, "events")), entity_columns(spec, _before))


def entity_recon_feed(spark: SparkSession, sf_dir: str, spec: EntitySpec) -> DataFrame:
    return _events(spark, sf_dir, recon_columns(key_columns(spec)))


def entity_streams(spark: SparkSession, sf_dir: str, spec: EntitySpec) -> tuple[DataFrame, DataFrame]:
    """Both feeds of an entity as streams over the ``events`` file itself."""
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema)
    events = spread(spark, events.option("pathGlobFilter", "events.parquet").parquet(sf_dir))
    return _derive(events, entity_columns(spec, _before)), _derive(events, recon_columns(key_columns(spec)))
