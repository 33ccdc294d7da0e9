"""Row-level change feed between two states of a keyed table."""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.functions import columns as fx

CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIME = "_change_type", "_commit_version", "_commit_timestamp"


def differs(left: Iterable[str], right: Iterable[str]) -> str:
    """Null-safe inequality of two rows, given as SQL texts."""
    return fx.any_of(f"NOT ({a} <=> {b})" for a, b in zip(left, right, strict=True))


def image_list(kind: str, before: str, after: str) -> str:
    """An array of ``change, row``: one image for an insert or delete, two for an update, null for no change."""

    def image(change, row):
        return f"named_struct('change', '{change}', 'row', {row})"

    return f"""CASE {kind}
        WHEN 'insert' THEN array({image("insert", after)})
        WHEN 'delete' THEN array({image("delete", before)})
        WHEN 'update' THEN array({image("update_preimage", before)}, {image("update_postimage", after)}) END"""


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Compare two states that hold one row per key. Unchanged rows emit nothing; null keys match null keys.

    Both states meet in one shuffle by key and one aggregate. Pass only touched keys to keep it proportional to the
    change.
    """
    names = new.columns
    row = f"struct({', '.join(map(fx.quoted, names))})"
    key = [f"{fx.quoted(k)} AS __key_{i}" for i, k in enumerate(keys)]
    sides = [
        side.selectExpr(*key, f"{when} AS __old", f"{other} AS __new")
        for side, when, other in ((old, row, f"if(false, {row}, null)"), (new, f"if(false, {row}, null)", row))
    ]
    groups = [f"__key_{i}" for i in range(len(keys))]
    both = sides[0].unionByName(sides[1]).groupBy(*groups).agg(
        F.expr("any_value(__old, true) AS __old"), F.expr("any_value(__new, true) AS __new")
    )
    kind = """CASE WHEN __old IS NULL THEN 'insert' WHEN __new IS NULL THEN 'delete'
        WHEN NOT (__old <=> __new) THEN 'update' END"""
    exploded = both.selectExpr(f"explode({image_list(kind, '__old', '__new')}) AS i")
    return exploded.selectExpr("i.row.*", f"i.change AS {CHANGE_TYPE}")


def net_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a feed over several commits amounts to: one insert, delete or pair of update images per key, or nothing.

    ``changes`` holds rows with change type and commit version. A key's first image tells what was there before, its
    last what is there after; keys that end as they began emit nothing. One aggregate that combines before its shuffle,
    so a key that changed in every commit weighs on no task.
    """
    names = [c for c in changes.columns if c not in (CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIME)]
    row = f"struct({', '.join(map(fx.quoted, names))})"
    gone = f"{CHANGE_TYPE} IN ('update_preimage', 'delete')"
    key = [f"{fx.quoted(k)} AS __key_{i}" for i, k in enumerate(keys)]
    # within a commit the image before comes first
    images = changes.selectExpr(
        *key, f"struct({COMMIT_VERSION} AS v, NOT {gone} AS after) AS __at", f"struct({gone} AS gone, {row} AS row) AS __image"
    )
    both = images.groupBy(*[f"__key_{i}" for i in range(len(keys))]).agg(
        F.expr("min_by(__image, __at) AS __first"), F.expr("max_by(__image, __at) AS __last")
    )
    both = both.selectExpr("if(__first.gone, __first.row, null) AS __old", "if(__last.gone, null, __last.row) AS __new")
    kind = """CASE WHEN __old IS NULL AND __new IS NULL THEN null WHEN __old IS NULL THEN 'insert'
        WHEN __new IS NULL THEN 'delete' WHEN NOT (__old <=> __new) THEN 'update' END"""
    exploded = both.selectExpr(f"explode({image_list(kind, '__old', '__new')}) AS i")
    return exploded.selectExpr("i.row.*", f"i.change AS {CHANGE_TYPE}")


def weight() -> str:
    """What an image adds to a count: a row that is there now 1, one that was there before -1."""
    return f"CASE WHEN {CHANGE_TYPE} IN ('insert', 'update_postimage') THEN 1 ELSE -1 END"


def aggregate_delta(changes: DataFrame, groups: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """By how much a feed changes each group's ``rows`` and ``sums``, given as name to expression over a row."""
    signed = changes.selectExpr(
        *map(fx.quoted, groups),
        f"cast({weight()} AS bigint) AS __weight",
        *[f"{expression} AS {fx.quoted(name)}" for name, expression in sums.items()],
    )
    return signed.groupBy(*groups).agg(
        F.expr("sum(__weight) AS rows"),
        *[F.expr(f"coalesce(sum({fx.quoted(n)} * __weight), 0) AS {fx.quoted(n)}") for n in sums],
    )


def applied(totals: DataFrame, delta: DataFrame, groups: Sequence[str], sums: Iterable[str]) -> DataFrame:
    """Totals after a delta; groups without rows go."""
    both = totals.unionByName(delta).groupBy(*groups)
    summed = both.agg(F.sum("rows").alias("rows"), *[F.sum(fx.quoted(n)).alias(n) for n in sums])
    return summed.where("rows <> 0")
