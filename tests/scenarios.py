"""Hand-made events over key (k1, k2) and columns a, b, ACTIVE_FLAG, DT_REMOVED, with an ideal in plain Python."""

from datetime import datetime

KEYS = ["k1", "k2"]
PAYLOAD = ["a", "b", "ACTIVE_FLAG", "DT_REMOVED"]
SCHEMA = (
    "k1 bigint, k2 bigint, a string, b bigint, ACTIVE_FLAG boolean, DT_REMOVED timestamp, "
    "__seq timestamp, __flow int, __arrival timestamp, __tie bigint"
)


def at(clock):
    hours, minutes = clock.split(":")
    return datetime(2024, 1, 1, int(hours), int(minutes))


def main(clock, a=None, b=None, key=(1, 10), removed=None, tie=0):
    removed = at(removed) if removed else None
    when = at(clock)
    return (*key, a, b, removed is None, removed, when, 0, when, tie)


def recon(clock, delete, removed=None, key=(1, 10), tie=0):
    when = at(clock)
    return (*key, None, None, False if delete else None, at(removed) if removed else None, when, 1, when, tie)


def frame(spark, events):
    return spark.createDataFrame(events, SCHEMA)


def expected(events):
    """Apply all events in order, skipping nulls."""
    state = {}
    for e in sorted((e for e in events if e[6] is not None), key=lambda e: e[6:10]):
        row = state.setdefault(e[:2], [None] * len(PAYLOAD))
        for i, value in enumerate(e[2:6]):
            if value is not None:
                row[i] = value
    return {k: tuple(v) for k, v in state.items()}


def rows_of(df):
    return {(r.k1, r.k2): tuple(r[c] for c in PAYLOAD) for r in df.collect()}
