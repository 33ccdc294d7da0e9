"""Entity declarations. Adding an entity means writing one ``EntitySpec``; no new code."""

from dataclasses import dataclass

from siltline.functions.naming import upper_snake

ACTIVE_FLAG = "ACTIVE_FLAG"
REMOVED_AT = "DT_REMOVED"
LOADED_BY = "LOADED_BY"
EFFECTIVE_AT = "DH_EFF_DT"
LOAD_TIME = "load_timestamp"
SEQUENCE = "_scd_sequence"
INGESTED_AT = "_ingested_at"
LINEAGE = (INGESTED_AT, "_source_system", "_source_table")


@dataclass(frozen=True)
class Source:
    """A target column read from one source column, renamed by rule unless ``target`` is given."""

    name: str
    target: str = ""
    cast: str | None = None

    def __post_init__(self):
        if not self.target:
            object.__setattr__(self, "target", upper_snake(self.name))


@dataclass(frozen=True)
class Null:
    """A target column the source does not have, kept as a typed null."""

    target: str
    cast: str


def named(text: str, casts: dict[str, str] | None = None) -> tuple[Source, ...]:
    """Whitespace-separated source names -> columns renamed by rule."""
    casts = casts or {}
    return tuple(Source(n, cast=casts.get(n)) for n in text.split())


def numbered(pattern: str, last: int) -> str:
    """``numbered('Field{:03d}', 3)`` -> ``'Field001 Field002 Field003'``."""
    return " ".join(pattern.format(i) for i in range(1, last + 1))


@dataclass(frozen=True)
class EntitySpec:
    """One keyed target fed by a main change feed and a hard-delete reconciliation feed.

    ``columns``     main-feed columns in target order, before the audit block
    ``keys``        target names of the key columns, the same for both feeds
    ``removed_by``  source column whose null means "active"; None = always active
    ``sequence``    source timestamps tried in order; empty = processing time
    ``audit_nulls`` typed nulls placed after the effective date
    """

    name: str
    keys: tuple[str, ...]
    columns: tuple[Source | Null, ...]
    sequence: tuple[str, ...] = ("RecordLastModified", INGESTED_AT)
    removed_by: str | None = "dtRemoved"
    audit_nulls: tuple[Null, ...] = ()
    suffix: str = "_sql"

    def __post_init__(self):
        targets = [c.target for c in self.columns]
        repeated = {t for t in targets if targets.count(t) > 1}
        if repeated:
            raise ValueError(f"{self.name}: columns produced twice: {sorted(repeated)}")
        sources = {c.target for c in self.columns if isinstance(c, Source)}
        missing = [k for k in self.keys if k not in sources]
        if missing:
            raise ValueError(f"{self.name}: keys not read from the feed: {missing}")

    @property
    def target(self) -> str:
        return self.name + self.suffix

    @property
    def sequence_column(self) -> str:
        """The view column that orders events; with processing time that is the load time itself."""
        return SEQUENCE if self.sequence else LOAD_TIME

    @property
    def excluded(self) -> tuple[str, ...]:
        """View columns that may order events but never reach the target."""
        return (LOAD_TIME, SEQUENCE) if self.sequence else (LOAD_TIME,)

    @property
    def key_sources(self) -> tuple[Source, ...]:
        by_target = {c.target: c for c in self.columns if isinstance(c, Source)}
        return tuple(by_target[k] for k in self.keys)

    @property
    def source_columns(self) -> tuple[str, ...]:
        """Distinct main-feed columns this entity reads, in first-use order."""
        read = [c.name for c in self.columns if isinstance(c, Source)]
        read += [self.removed_by] if self.removed_by else []
        return tuple(dict.fromkeys([*read, *self.sequence, *LINEAGE]))

    @property
    def main_columns(self) -> tuple[str, ...]:
        tail = (SEQUENCE,) if self.sequence else ()
        return (
            *[c.target for c in self.columns],
            ACTIVE_FLAG,
            LOADED_BY,
            EFFECTIVE_AT,
            *[c.target for c in self.audit_nulls],
            *LINEAGE,
            LOAD_TIME,
            *tail,
        )

    @property
    def target_columns(self) -> tuple[str, ...]:
        """Main columns plus what only the reconciliation feed has, minus the excluded ones."""
        both = dict.fromkeys([*self.main_columns, *self.keys, ACTIVE_FLAG, REMOVED_AT])
        return tuple(c for c in both if c not in self.excluded)
