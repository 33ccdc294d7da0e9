"""The scalar expressions of the conform step and of the merge, as Spark SQL text."""

from collections.abc import Iterable, Sequence

MASK_BITS = 63  # bits used per bigint mask; the sign bit stays clear


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def aliased(expression: str, name: str) -> str:
    return f"{expression} AS {quoted(name)}"


def renamed(source: str, target: str) -> str:
    return aliased(quoted(source), target)


def convert(expression: str, to: str, on_error: str = "fail") -> str:
    """Cast; ``on_error='null'`` turns malformed values into null instead of failing the job, as does ``'reject'``,
    where the caller sends their rows to the rejects."""
    if on_error not in ("fail", "null", "reject"):
        raise ValueError(f"on_error must be 'fail', 'null' or 'reject', not {on_error!r}")
    return f"{'cast' if on_error == 'fail' else 'try_cast'}({expression} AS {to})"


def cast_errors(casts: Iterable[tuple[str, str, str]]) -> str:
    """The names of those casts, given as (expression, type, name), that would lose a value; null if there are none."""
    failed = [f"if({e} IS NOT NULL AND {convert(e, to, 'null')} IS NULL, {text(name)}, null)" for e, to, name in casts]
    return f"nullif(array_compact(array({', '.join(failed)})), cast(array() AS array<string>))"


def typed_null(to: str) -> str:
    return f"cast(null AS {to})"


def soft_delete_flag(removed_at: str) -> str:
    """Active while no removal time is set; never null."""
    return f"({quoted(removed_at)} IS NULL)"


def hard_delete_flag(hard_delete: str) -> str:
    """``false`` for a confirmed delete, otherwise null, which the merge reads as "no change"."""
    return f"CASE WHEN {quoted(hard_delete)} THEN false END"


def first_known(names: Sequence[str]) -> str:
    """Sequence by fallback: the first non-null of the columns, not the greatest."""
    return f"coalesce({', '.join(map(quoted, names))})"


def load_user(user: str | None = None) -> str:
    return "cast(session_user() AS string)" if user is None else text(user)


def load_time(moment=None) -> str:
    return "current_timestamp()" if moment is None else f"cast({text(moment)} AS timestamp)"


def any_of(conditions: Iterable[str]) -> str:
    return "(" + " OR ".join(conditions) + ")"


def mask_count(names: Sequence[str]) -> int:
    return (len(names) + MASK_BITS - 1) // MASK_BITS


def presence_masks(names: Sequence[str]) -> list[str]:
    """Bigint bit sets telling which columns of a row are non-null, 63 columns per mask."""
    return [
        " | ".join(
            f"if({quoted(n)} IS NULL, 0L, {1 << i}L)" for i, n in enumerate(names[start : start + MASK_BITS])
        )
        for start in range(0, len(names), MASK_BITS)
    ]


def has_bit(prefix: str, position: int) -> str:
    return f"({prefix}{position // MASK_BITS} & {1 << (position % MASK_BITS)}L) != 0"


def any_bit(prefix: str, names: Sequence[str]) -> str:
    """True where any bit of the masks over ``names`` is set."""
    return any_of(f"{prefix}{i} != 0" for i in range(mask_count(names)))


def names_of_bits(prefix: str, names: Sequence[str]) -> str:
    """The names whose bits are set, as an array; one short lambda per mask instead of a branch per name."""
    parts = [
        f"filter(array({', '.join(map(text, names[start : start + MASK_BITS]))}), (name, i) -> (shiftright({prefix}{n}, i) & 1L) = 1L)"
        for n, start in enumerate(range(0, len(names), MASK_BITS))
    ]
    return f"concat({', '.join(parts)})"


def row_hash(names: Sequence[str]) -> str:
    """64-bit hash of a row's values *and* null positions.

    ``xxhash64`` skips nulls, so ``(null, 'a')`` and ``('a', null)`` would collide without the masks.
    """
    return f"xxhash64({', '.join([*map(quoted, names), *presence_masks(names)])})"


def key_slot(keys: Sequence[str], slots: int) -> str:
    """A stable number in ``0..slots-1`` for a key; null key parts are allowed."""
    return f"cast(pmod(xxhash64({', '.join(map(quoted, keys))}), {slots}) AS int)"
