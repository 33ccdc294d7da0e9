"""Incremental form of the upsert: one state row per key that can absorb more events later.

A state row is the target row plus ``__events``: the order of every surviving event, newest first, with the
names of the columns it owns. The newest owner lists no names; it owns whatever the others do not. Consumers
select the target columns and never read the rest.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltline.functions import columns as fx
from siltline.operators.changes import differs, image_list
from siltline.operators.upsert import ORDER, all_of, is_internal, newest_first, payload_columns, still_matters, with_ownership, with_presence

EVENTS, CHANGE, BEFORE, FROM_STATE = "__events", "__change", "__before", "__from_state"
BUCKET, SPLIT, KIND, STATE = "silt_bucket", "__split", "silt_kind", "state"
PLACE, ROW = "__place", "__row"
_ORDER = ", ".join(ORDER)


def to_events(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State rows -> their surviving events, each holding only the columns it owns."""
    payload = payload_columns(state, keys)
    listed = f"flatten(transform({EVENTS}, e -> coalesce(e.owns, cast(array() AS array<string>)))) AS __listed"
    columns = [*map(fx.quoted, keys), *map(fx.quoted, payload)]
    rows = state.selectExpr(*columns, listed, f"explode({EVENTS}) AS __event")

    def owned(name):
        by_rest = f"__event.owns IS NULL AND NOT array_contains(__listed, {fx.text(name)})"
        by_name = f"array_contains(__event.owns, {fx.text(name)})"
        return fx.aliased(f"if({by_rest} OR {by_name}, {fx.quoted(name)}, null)", name)

    return rows.selectExpr(*map(fx.quoted, keys), *map(owned, payload), *[f"__event.{o} AS {o}" for o in ORDER])


def absorb(
    state: DataFrame | None,
    events: DataFrame,
    keys: Sequence[str],
    *,
    bucket: str | None = None,
    splits: int = 1,
    partitions: int | None = None,
    every_bucket: bool = False,
    stored: StructType | None = None,
    track_changes: bool = True,
) -> DataFrame:
    """Merge events into state rows; returns new state rows and what changed.

    ``__change`` is 'insert', 'update' or null; ``__before`` is the old row of an update, or null. Without
    ``track_changes`` updates are not told apart. With ``bucket``, an expression over the keys, rows are shuffled by
    bucket and one of ``splits`` parts of it, in ``partitions`` tasks, and stay grouped that way, ready for a bucketed
    write; if the events touch ``every_bucket`` from the first to the last of theirs, each part has a task to itself. Columns of ``stored``, the table's schema so far, are kept even where neither side has them.
    """
    missing = [f for f in stored or () if f.name not in events.columns and not is_internal(f.name)]
    if missing:
        events = events.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    payload = [*payload_columns(events, keys)]
    if state is not None:  # a column only the state has is kept
        payload += [c for c in payload_columns(state, keys) if c not in payload]
    merged = events
    if state is not None:
        old = to_events(state, keys).selectExpr("*", f"true AS {FROM_STATE}")
        merged = events.selectExpr("*", f"false AS {FROM_STATE}").unionByName(old, allowMissingColumns=True)
    # an event's values travel as one struct: up to the wide window a row is a few columns and one block of bytes
    row = f"struct({', '.join(map(fx.quoted, payload))}) AS {ROW}"
    masks = [f"__has{i}" for i in range(fx.mask_count(payload))]
    flag = [FROM_STATE] if state is not None else []
    merged = with_presence(merged, payload).selectExpr(*map(fx.quoted, keys), *ORDER, *flag, *masks, row)
    groups = list(keys)
    if bucket is not None:
        # murmur3, unlike the bucket's xxhash64: with the same hash a bucket could fall into one split
        named = ", ".join(map(fx.quoted, keys))
        split = f"cast({bucket} * {splits} + pmod(hash({named}), {splits}) AS int) AS {SPLIT}"
        merged = merged.selectExpr("*", f"{bucket} AS {BUCKET}", split)
        if every_bucket and partitions and hasattr(merged, "repartitionById"):  # since Spark 4.1
            merged = merged.repartitionById(partitions, F.col(SPLIT))  # a hash would leave tasks empty and give others four parts
        else:
            merged = merged.repartition(*([partitions] if partitions else []), BUCKET, SPLIT)
        # Spark's sort compares eight bytes of the first column before it looks into the rows; a task has few buckets
        merged = merged.selectExpr("*", f"xxhash64({named}) AS {PLACE}")
        groups = [PLACE, BUCKET, SPLIT, *keys]

    # at most one event owns a column, and one of the state's holds its old value, so first and last are the same; Spark
    # makes a frame and generated code of its own in every task out of each first, but only one out of all last
    window = newest_first(groups)
    every = all_of(window)
    owns = fx.names_of_bits("__own", payload)
    entry = f"struct({_ORDER}, if({fx.any_bit('__newer', payload)}, {owns}, null) AS owns)"
    kept = [BUCKET, *keys] if bucket is not None else list(keys)
    out = [
        *map(fx.quoted, kept),
        *[
            f"last(if({fx.has_bit('__own', i)}, {ROW}.{fx.quoted(c)}, null), true) OVER ({every}) AS {fx.quoted(c)}"
            for i, c in enumerate(payload)
        ],
        *ORDER,
        f"row_number() OVER ({window}) AS __rank",
        f"collect_list(if({fx.any_bit('__own', payload)}, {entry}, null)) OVER ({every}) AS {EVENTS}",
    ]
    compare = state is not None and track_changes
    if state is not None:
        out.append(f"max({FROM_STATE}) OVER ({every}) AS {FROM_STATE}")
    if compare:
        out += [
            f"last(if({FROM_STATE}, {ROW}.{fx.quoted(c)}, null), true) OVER ({every}) AS {_old(c)}" for c in payload
        ]
    # the wide window sees only what it needs: a few events per key, and all that the state has, for its old values
    needed = still_matters(payload) + (f" OR {FROM_STATE}" if state is not None else "")
    rows = with_ownership(merged, groups, payload).where(needed).selectExpr(*out).where("__rank = 1")

    # a key whose events are all null still needs one event to exist
    alone = f"array(struct({_ORDER}, cast(null AS array<string>) AS owns))"
    result = [
        *map(fx.quoted, kept),
        *map(fx.quoted, payload),
        f"if(size({EVENTS}) = 0, {alone}, {EVENTS}) AS {EVENTS}",
    ]
    if not compare:
        change = "'insert'" if state is None else f"if({FROM_STATE}, null, 'insert')"
        row = ", ".join([*map(fx.quoted, keys), *map(fx.quoted, payload)])
        none = [f"if(false, struct({row}), null) AS {BEFORE}"] if track_changes else []
        return rows.selectExpr(*result, f"{change} AS {CHANGE}", *none)
    changed = differs(map(_old, payload), map(fx.quoted, payload))
    old_row = [fx.quoted(k) for k in keys] + [f"{_old(c)} AS {fx.quoted(c)}" for c in payload]
    change = f"CASE WHEN NOT {FROM_STATE} THEN 'insert' WHEN {changed} THEN 'update' END AS {CHANGE}"
    rows = rows.selectExpr(*result, change, f"struct({', '.join(old_row)}) AS {BEFORE}")
    others = [fx.quoted(c) for c in rows.columns if c != BEFORE]
    return rows.selectExpr(*others, f"if({CHANGE} = 'update', {BEFORE}, null) AS {BEFORE}")


def images(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a commit writes, from :func:`absorb` with a bucket: for every row its new state, and if it changed, the
    images of the change feed. ``silt_kind`` is 'state' or a change type; images lie in bucket -1."""
    names = [*keys, *payload_columns(rows, keys)]
    after = f"struct({', '.join(map(fx.quoted, names))})"
    before = BEFORE if BEFORE in rows.columns else f"if(false, {after}, null)"
    state = f"array(named_struct('change', '{STATE}', 'row', {after}))"
    none = f"slice({state}, 1, 0)"
    every = f"concat({state}, coalesce({image_list(CHANGE, before, after)}, {none}))"
    exploded = rows.selectExpr(BUCKET, EVENTS, f"explode({every}) AS i")
    return exploded.selectExpr(
        "i.row.*",
        f"if(i.change = '{STATE}', {EVENTS}, null) AS {EVENTS}",
        f"i.change AS {KIND}",
        f"if(i.change = '{STATE}', {BUCKET}, -1) AS {BUCKET}",
    )


def _old(column: str) -> str:
    return fx.quoted(f"__old_{column}")
