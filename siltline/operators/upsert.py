"""The type-1 upsert, resolved column by column in sequence order.

A change event is a row of key columns, payload columns and the four order columns. For every key and payload
column the result holds the value of the greatest-ordered event in which that column is non-null. That equals
applying all events in sequence order while skipping nulls, so neither arrival order nor batching matters.
"""

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from siltline.functions import columns as fx

SEQ, FLOW, ARRIVAL, TIE = ORDER = ("__seq", "__flow", "__arrival", "__tie")
REASONS = "__reject_reasons"  # why an event cannot be merged; such an event has no sequence either

# Keys are counted in this many hash slots first, which bounds the broadcast list of crowded slots. A key is hot if it
# has more than HOT_ROWS events and at least one eighth of its slot's: at most 8 keys per slot, a million in all.
HOT_SLOTS = 1 << 17
SLOT_SHARE = 8
HOT_ROWS = 500_000
FOLD_COLUMNS = 12  # with more columns a window that all share was not slower (600,000 lines, mostly unique keys)

# columns that the merge itself adds; a payload column may not use these names
INTERNAL = frozenset(
    [*ORDER, REASONS, "__slot", "__rows", "__slot_rows", "__parts", "__part", "__rank", "__events", "__change", "__before"]
    + ["__from_state", "__split", "__place", "__row", "__event", "__listed", "__kind", "__images", "silt_bucket", "silt_kind"]
)


def is_internal(name: str) -> bool:
    return name in INTERNAL or re.fullmatch(r"__(has|newer|own)\d+|__old_.*|__hot_.*", name) is not None


def refuse_internal(names: Iterable[str]) -> None:
    taken = sorted(n for n in names if is_internal(n))
    if taken:
        raise ValueError(f"column names that the merge uses itself: {taken}")


def payload_columns(events: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in events.columns if c not in keys and not is_internal(c)]


def newest_first(groups: Sequence[str]) -> str:
    newest = ", ".join(f"{c} DESC NULLS LAST" for c in ORDER)
    return f"PARTITION BY {', '.join(map(fx.quoted, groups))} ORDER BY {newest}"


def all_of(window: str) -> str:
    return f"{window} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


def split_rejects(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events that can be merged, and those that cannot: their sequence is null, or has been blanked for the reasons
    that come with them, which the rejects hold as ``reject_reasons``."""
    good, bad = events.where(f"{SEQ} IS NOT NULL"), events.where(f"{SEQ} IS NULL")
    return good.drop(REASONS), bad.withColumnRenamed(REASONS, "reject_reasons")


def with_presence(events: DataFrame, payload: Sequence[str]) -> DataFrame:
    """Add ``__has<i>`` bit masks: which columns an event sets. A bigint per 63 columns."""
    return events.selectExpr("*", *[f"{m} AS __has{i}" for i, m in enumerate(fx.presence_masks(payload))])


def with_ownership(events: DataFrame, groups: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Add ``__newer<i>`` and ``__own<i>`` bit masks per event, from its ``__has<i>``.

    ``__newer`` marks the columns some newer event of the group already sets; ``__own`` the columns for which
    this event holds the newest value. Only the masks run through the window.
    """
    masks = range(fx.mask_count(payload))
    before = f"{newest_first(groups)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    newer = [f"coalesce(bit_or(__has{i}) OVER ({before}), 0L) AS __newer{i}" for i in masks]
    marked = events.selectExpr("*", *newer)
    return marked.selectExpr("*", *[f"__has{i} & ~__newer{i} AS __own{i}" for i in masks])


def survivors(events: DataFrame, keys: Sequence[str], split_by: Sequence[str] = ()) -> DataFrame:
    """Keep only events that still matter: owners of at least one column, and the newest of the group.

    Columns an event does not own are blanked. ``survivors`` is associative and idempotent: it may be applied to
    any parts of a feed, and to its own output together with more events, without changing ``current``. A group
    keeps at most one event more than it has payload columns, in practice one to three.
    """
    payload = payload_columns(events, keys)
    if not payload:
        return events.dropDuplicates(list(keys))
    marked = with_ownership(with_presence(events, payload), [*keys, *split_by], payload)
    kept = marked.where(still_matters(payload))
    return kept.selectExpr(
        *map(fx.quoted, keys),
        *[f"if({fx.has_bit('__own', i)}, {fx.quoted(c)}, null) AS {fx.quoted(c)}" for i, c in enumerate(payload)],
        *ORDER,
    )


def still_matters(payload: Sequence[str]) -> str:
    """Whether an event with ownership masks owns a column or is the newest of its group."""
    # an all-null event is kept only while nothing newer sets any column, so an all-null key still exists
    return f"({fx.any_bit('__own', payload)} OR NOT {fx.any_bit('__newer', payload)})"


def hot_keys(events: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``__hot_0..n`` (the key) and ``__parts`` for keys above ``hot_rows``.

    Events are counted per hash slot: a scan of the key columns that combines map-side to at most ``HOT_SLOTS`` rows.
    Only keys in slots above the limit are then counted one by one, so many small keys sharing a slot stay calm.
    """
    slot = f"{fx.key_slot(keys, HOT_SLOTS)} AS __slot"
    slots = events.selectExpr(slot).groupBy("__slot").agg(F.expr("count(1) AS __slot_rows"))
    crowded = F.broadcast(slots.where(f"__slot_rows > {hot_rows}"))
    names = [fx.aliased(fx.quoted(k), f"__hot_{i}") for i, k in enumerate(keys)]
    suspects = events.selectExpr(*names, slot).join(crowded, "__slot")
    per_key = suspects.groupBy(*[f"__hot_{i}" for i in range(len(keys))]).agg(
        F.expr("count(1) AS __rows"), F.expr("any_value(__slot_rows) AS __slot_rows")
    )
    hot = per_key.where(f"__rows > {hot_rows} AND __rows * {SLOT_SHARE} >= __slot_rows")
    # as many parts as rows in a part: neither a part nor the survivors of all parts weigh on one task
    return hot.selectExpr(*[f"__hot_{i}" for i in range(len(keys))], "cast(ceil(sqrt(__rows)) AS bigint) AS __parts")


def condense_hot_keys(events: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Shrink keys with very many events to their survivors before anything is shuffled by key.

    Rows of hot keys are dealt to about sqrt(rows) parts per key and condensed per (key, part); all other rows pass
    through untouched. A row's part follows from its place in the order and its input partition, so a task that runs
    again deals it the same way. The list of hot keys has a bounded size (see ``HOT_SLOTS``), so it is broadcast. If
    no key is hot, adaptive execution drops the branch and its joins at run time. Which keys count as hot never
    changes a result.
    """
    hot = hot_keys(events, keys, hot_rows)
    same = F.expr(" AND ".join(f"{fx.quoted(k)} <=> __hot_{i}" for i, k in enumerate(keys)))
    calm = events.join(F.broadcast(hot), same, "left_anti")
    part = f"pmod(xxhash64({', '.join(ORDER)}, spark_partition_id()), __parts) AS __part"
    dealt = events.join(F.broadcast(hot), same).selectExpr(*map(fx.quoted, events.columns), part)
    return calm.unionByName(survivors(dealt, keys, split_by=["__part"]))


def current(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest non-null value of every payload column, one row per key.

    One shuffle and one sort by key; every column shares the same window, whose frames spill to disk.
    """
    window = newest_first(keys)
    latest = [
        f"first({fx.quoted(c)}, true) OVER ({all_of(window)}) AS {fx.quoted(c)}"
        for c in payload_columns(events, keys)
    ]
    ranked = events.selectExpr(*map(fx.quoted, keys), *latest, f"row_number() OVER ({window}) AS __rank")
    return ranked.where("__rank = 1").drop("__rank")


def folded(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same as :func:`current`, as one aggregate: per column the greatest (order, value) of the events that have one.

    Events are combined before the shuffle, so a hot key leaves one row per task and needs no search of its own, and the
    source is scanned once. Every column carries its own order, which is why this suits few columns.
    """
    order = ", ".join(ORDER)
    newest = [
        F.expr(f"max(if({fx.quoted(c)} IS NULL, null, struct({order}, {fx.quoted(c)} AS __value))).__value").alias(c)
        for c in payload_columns(events, keys)
    ]
    if not newest:
        return events.select(*map(fx.quoted, keys)).distinct()
    return events.groupBy(*map(fx.quoted, keys)).agg(*newest)


def orderable(kind: DataType) -> bool:
    """Whether values of a type can be compared, as :func:`folded` needs it."""
    if isinstance(kind, ArrayType):
        return orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(orderable(f.dataType) for f in kind)
    return not isinstance(kind, MapType | VariantType)


def upsert(
    events: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS, fold_columns: int = FOLD_COLUMNS
) -> DataFrame:
    """Batch upsert: the current-state table after all events. Events without a sequence are left out;
    take them from :func:`split_rejects`.

    Up to ``fold_columns`` payload columns are folded map-side; more, or maps, are resolved by a window after a search
    for hot keys, which ``hot_rows=None`` skips.
    """
    ordered, _ = split_rejects(events)
    payload = payload_columns(events, keys)
    if len(payload) <= fold_columns and all(orderable(events.schema[c].dataType) for c in payload):
        return folded(ordered, keys)
    if hot_rows is not None:
        ordered = condense_hot_keys(ordered, keys, hot_rows)
    return current(ordered, keys)
