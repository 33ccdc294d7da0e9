import random

import pytest
from pyspark.sql import functions as F
from scenarios import KEYS, frame, main, recon

from siltline.operators.changes import aggregate_delta, change_feed, net_changes
from siltline.sources.workspace import scratch
from siltline.streaming import derived
from siltline.streaming.derived import KeptAggregate
from siltline.streaming.target import KeyedTable


def test_kinds_and_nulls(spark):
    schema = "k bigint, v string, n bigint"
    old = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3), (None, "x", 1), (5, "gone", 5)], schema)
    new = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, None, 3), (None, "y", 1), (4, "d", None)], schema)
    got = sorted(change_feed(old, new, ["k"]).collect(), key=str)
    assert sorted(((r.k, r.v, r.n, r["_change_type"]) for r in got), key=str) == sorted(
        [
            (2, "b", None, "update_preimage"),
            (2, "b", 2, "update_postimage"),
            (3, "c", 3, "update_preimage"),
            (3, None, 3, "update_postimage"),
            (None, "x", 1, "update_preimage"),
            (None, "y", 1, "update_postimage"),
            (4, "d", None, "insert"),
            (5, "gone", 5, "delete"),
        ],
        key=str,
    )


def test_equal_states_emit_nothing(spark):
    rows = spark.createDataFrame([(1, None), (None, "a")], "k bigint, v string")
    assert change_feed(rows, rows, ["k"]).count() == 0


def test_net_changes_skip_what_lies_between(spark):
    """Random states, one after another: the net feed of any range is the plain feed from its first to its last state."""
    rng, states = random.Random(4), [{}]
    for _ in range(6):
        state = dict(states[-1])
        for key in rng.sample([1, 2, 3, 4, None], 3):
            state.pop(key, None)
            if rng.random() < 0.7:
                state[key] = rng.choice(["a", "b", None])
        states.append(state)
    frames = [spark.createDataFrame([(k, v) for k, v in s.items()], "k bigint, v string") for s in states]
    feeds = [
        change_feed(a, b, ["k"]).selectExpr("*", f"{i}L AS _commit_version", "now() AS _commit_timestamp")
        for i, (a, b) in enumerate(zip(frames, frames[1:], strict=False), 1)
    ]

    def union(parts):
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    for since, until in ((1, 6), (2, 4), (3, 3), (4, 6)):
        got = net_changes(union(feeds[since - 1 : until]).repartition(3), ["k"])
        want = change_feed(frames[since - 1], frames[until], ["k"])
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), (since, until)


def test_net_changes_are_one_shuffle_with_partial_aggregates(spark):
    rows = spark.range(100).selectExpr("id % 7 AS k", "id AS v", "'insert' AS _change_type", "id AS _commit_version")
    text = net_changes(rows, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "partial_max_by" in text


def test_signed_weights(spark):
    rows = [("x", 5, "insert"), ("x", 3, "update_preimage"), ("y", 4, "update_postimage"), (None, 9, "delete"), ("z", None, "insert")]
    changes = spark.createDataFrame(rows, "g string, n bigint, _change_type string")
    got = {r.g: (r.rows, r.total) for r in aggregate_delta(changes, ["g"], {"total": "n"}).collect()}
    assert got == {"x": (0, 2), "y": (1, 4), None: (-1, -9), "z": (1, 0)}


def test_a_kept_aggregate_equals_a_recount(spark, monkeypatch):
    root = scratch(spark, "kept")
    table = KeyedTable(spark, f"{root}/table", KEYS, buckets=2)
    kept = KeptAggregate(table, f"{root}/totals", ["a", "ACTIVE_FLAG"], {"b": "b"})
    assert kept.refresh() == 0
    with pytest.raises(ValueError, match="not been refreshed"):
        kept.read()

    def recount():
        rows = table.read().groupBy("a", "ACTIVE_FLAG").agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0)))
        return sorted(map(tuple, rows.collect()), key=str)

    def totals(version=None):
        return sorted((tuple(r) for r in kept.read(version).select("a", "ACTIVE_FLAG", "rows", "b").collect()), key=str)

    table.merge(frame(spark, [main("10:00", "x", i, key=(1, i)) for i in range(6)]))
    assert kept.refresh() == 1 and totals() == recount()
    first = recount()
    table.merge(frame(spark, [main("11:00", "y", 7, key=(1, 2)), recon("12:00", True, "11:00", key=(1, 3))]))
    table.merge(frame(spark, [main("13:00", "z", key=(2, 2)), main("13:00", "x", None, key=(1, 2))]))

    # a refresh that dies after writing leaves the totals as they were
    real = derived.publish_text
    monkeypatch.setattr(derived, "publish_text", lambda *_: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError, match="gone"):
        kept.refresh()
    monkeypatch.setattr(derived, "publish_text", real)
    assert kept.versions() == [1] and totals() == first

    assert kept.refresh(until=2) == 2
    assert kept.refresh() == 3 and kept.refresh() == 3
    assert totals() == recount() and totals(1) == first
    table.merge(frame(spark, [main("14:00", "w", i, key=(1, i)) for i in range(6)] + [main("14:00", "w", 1, key=(2, 2))]))
    kept.refresh()
    assert totals() == recount() and all(r[0] == "w" for r in totals())  # groups without rows are gone
