"""Bronze feed -> conformed view -> ordered change events.

Each step is one projection, so it runs unchanged on batch and streaming DataFrames and Catalyst collapses the
steps into a single one that prunes the scan to the columns read.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.functions import columns as fx
from siltline.operators.upsert import ARRIVAL, FLOW, ORDER, REASONS, SEQ, TIE, refuse_internal
from siltline.plans.spec import (
    ACTIVE_FLAG,
    EFFECTIVE_AT,
    INGESTED_AT,
    LINEAGE,
    LOAD_TIME,
    LOADED_BY,
    REMOVED_AT,
    EntitySpec,
    Null,
    Source,
)

MAIN, RECON = 0, 1


def conform_main(
    feed: DataFrame,
    spec: EntitySpec,
    *,
    load_time=None,
    load_user=None,
    on_cast_error="fail",
    absent="fail",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """The main view: rename, cast, active flag, audit block and sequence.

    ``load_time`` and ``load_user`` replace the processing time and session user, for reproducible runs;
    ``carry`` names feed columns to pass along as they are. With ``on_cast_error="reject"`` an extra column names the
    columns whose casts failed. With ``absent="null"`` declared columns that the feed lacks are nulls; see
    :func:`absent_columns`.
    """
    if absent not in ("fail", "null"):
        raise ValueError(f"absent must be 'fail' or 'null', not {absent!r}")
    gone = absent_columns(feed, spec) if absent == "null" else set()
    out = []
    for column in spec.columns:
        if isinstance(column, Source) and column.name in gone:
            if not column.cast:
                continue
            value = fx.typed_null(column.cast)
        elif isinstance(column, Null):
            value = fx.typed_null(column.cast)
        elif column.cast:
            value = fx.convert(fx.quoted(column.name), column.cast, on_cast_error)
        else:
            value = fx.quoted(column.name)
        out.append(fx.aliased(value, column.target))
    out += [
        fx.aliased(fx.soft_delete_flag(spec.removed_by) if spec.removed_by else "true", ACTIVE_FLAG),
        fx.aliased(fx.load_user(load_user), LOADED_BY),
        fx.renamed(INGESTED_AT, EFFECTIVE_AT),
        *[fx.aliased(fx.typed_null(c.cast), c.target) for c in spec.audit_nulls],
        *[fx.aliased(fx.typed_null("string"), c) if c in gone else c for c in LINEAGE],
        fx.aliased(fx.load_time(load_time), LOAD_TIME),
    ]
    if spec.sequence:
        out.append(fx.aliased(fx.first_known([c for c in spec.sequence if c not in gone]), spec.sequence_column))
    if on_cast_error == "reject":
        read = [c for c in spec.columns if isinstance(c, Source) and c.name not in gone]
        casts = [(fx.quoted(c.name), c.cast, c.target) for c in read if c.cast]
        out.append(fx.aliased(fx.cast_errors(casts) if casts else "cast(null AS array<string>)", REASONS))
    return feed.selectExpr(*out, *map(fx.quoted, carry))


def absent_columns(feed: DataFrame, spec: EntitySpec) -> set[str]:
    """The source columns of ``spec`` that the feed lacks, where it can do without them.

    A column with a cast is then a null of that type. One without has no type of its own and is left out: a keyed table
    keeps what it has under that name. Sequence columns are skipped while one of them is there. Keys, the ingestion time
    and the removal time are never optional, since without them a row's place or state would be made up.
    """
    there = {c.lower() for c in feed.columns}  # Spark's names have no case either
    gone = {c for c in spec.source_columns if c.lower() not in there}
    needed = {k.name for k in spec.key_sources} | {INGESTED_AT, spec.removed_by}
    if spec.sequence and gone.issuperset(spec.sequence):
        needed |= set(spec.sequence)
    if gone & needed:
        raise ValueError(f"{spec.name}: the feed lacks {sorted(gone & needed)}")
    return gone


def cast_failures(feed: DataFrame, spec: EntitySpec) -> DataFrame:
    """``column_name, failed``: how many values of each cast column ``on_cast_error='null'`` would blank.

    One aggregate over the cast columns; a spec without casts gives no rows.
    """
    casts = [c for c in spec.columns if not isinstance(c, Null) and c.cast]
    if not casts:
        return feed.sparkSession.createDataFrame([], "column_name string, failed bigint")
    lost = [
        fx.aliased(
            f"count_if({fx.quoted(c.name)} IS NOT NULL AND {fx.convert(fx.quoted(c.name), c.cast, 'null')} IS NULL)",
            c.target,
        )
        for c in casts
    ]
    pairs = ", ".join(f"struct({fx.text(c.target)} AS column_name, {fx.quoted(c.target)} AS failed)" for c in casts)
    return feed.selectExpr(*lost).selectExpr(f"inline(array({pairs}))")


def conform_recon(
    feed: DataFrame, spec: EntitySpec, *, load_time=None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """The reconciliation view: keys, hard-delete flag, removal time and sequence, nothing else."""
    out = [
        *[fx.renamed(k.name, k.target) for k in spec.key_sources],
        fx.aliased(fx.hard_delete_flag("hard_delete"), ACTIVE_FLAG),
        fx.renamed("dt_removed", REMOVED_AT),
        fx.renamed("ingested_at", spec.sequence_column),
    ]
    if spec.sequence:
        out.append(fx.aliased(fx.load_time(load_time), LOAD_TIME))
    return feed.selectExpr(*out, *map(fx.quoted, carry))


def as_events(
    view: DataFrame,
    *,
    sequence: str,
    flow: int,
    arrival: str,
    exclude: tuple[str, ...] = (),
    tie: str | None = None,
) -> DataFrame:
    """Attach the total order of the merge and drop columns that must not reach the target.

    Order: sequence, then flow, then arrival, then ``tie`` (a column) or a hash of the whole payload. The
    hash is taken here, once, because the merge later blanks payload columns an event no longer owns.
    """
    payload = [c for c in view.columns if c not in exclude and c not in (tie, REASONS)]
    refuse_internal(payload)
    last = f"cast({fx.quoted(tie)} AS bigint)" if tie else fx.row_hash(payload)
    order = [fx.renamed(sequence, SEQ), fx.aliased(str(flow), FLOW), fx.renamed(arrival, ARRIVAL), fx.aliased(last, TIE)]
    if REASONS in view.columns:
        late = f"if({fx.quoted(sequence)} IS NULL, array({fx.text(sequence)}), null)"
        reasons = f"nullif(concat(coalesce({REASONS}, array()), coalesce({late}, array())), cast(array() AS array<string>))"
        order[0] = f"if({REASONS} IS NULL, {fx.quoted(sequence)}, null) AS {SEQ}"
        order.append(f"{reasons} AS {REASONS}")
    return view.selectExpr(*map(fx.quoted, payload), *order)


def change_events(
    spec: EntitySpec,
    main: DataFrame,
    recon: DataFrame | None = None,
    *,
    load_time=None,
    load_user=None,
    on_cast_error="fail",
    absent="fail",
    tie: str | None = None,
) -> DataFrame:
    """Both feeds of an entity as one set of change events over the target's columns.

    ``tie`` names a bigint column of both feeds that orders otherwise equal events. ``on_cast_error="reject"`` makes
    main rows with malformed values rejects, with the names of those columns; see ``split_rejects``. ``absent="null"``
    lets the main feed lack declared columns; see ``absent_columns``.
    """
    carry = (tie,) if tie else ()
    order = dict(sequence=spec.sequence_column, exclude=spec.excluded, tie=tie)
    view = conform_main(
        main, spec, load_time=load_time, load_user=load_user, on_cast_error=on_cast_error, absent=absent, carry=carry
    )
    events = as_events(view, flow=MAIN, arrival=INGESTED_AT, **order)
    if recon is not None:
        view = conform_recon(recon, spec, load_time=load_time, carry=carry)
        removals = as_events(view, flow=RECON, arrival=spec.sequence_column, **order)
        events = events.unionByName(removals, allowMissingColumns=True)
    present = [c for c in spec.target_columns if c in events.columns]
    reasons = [REASONS] if REASONS in events.columns else []
    return events.selectExpr(*map(fx.quoted, present), *ORDER, *reasons)


def recon_from_snapshots(before: DataFrame, after: DataFrame, spec: EntitySpec, *, taken_at) -> DataFrame:
    """The reconciliation feed that two full sets of the source's keys imply: keys gone from the later one are removed.

    The snapshots hold the entity's key columns under their source names, in any number of copies; null key parts
    compare like values. Keys that came back are left to the main feed. One aggregate, combined before its shuffle.
    ``taken_at`` is when the later snapshot was taken.
    """
    keys = [fx.quoted(k.name) for k in spec.key_sources]
    sides = [s.selectExpr(*keys, f"{flag} AS __there") for s, flag in ((before, "false"), (after, "true"))]
    gone = sides[0].unionByName(sides[1]).groupBy(*keys).agg(F.expr("max(__there) AS __there")).where("NOT __there")
    moment = fx.load_time(taken_at)
    return gone.selectExpr(*keys, "true AS hard_delete", f"{moment} AS dt_removed", f"{moment} AS ingested_at")
