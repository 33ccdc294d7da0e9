"""The upsert in the state store, and the hand-over from a first load to the stream."""

import pytest
from scenarios import KEYS, expected, frame, rows_of
from test_stream import write_parts
from test_upsert import random_events

from siltline.operators.conform import change_events
from siltline.operators.upsert import upsert
from siltline.plans import contract
from siltline.sources.feeds import folder_feed
from siltline.sources.workspace import scratch
from siltline.streaming import statestore
from siltline.streaming.handover import FIRST_LOAD, SplitFeed, load_then_stream
from siltline.streaming.statestore import RowLog, latest_in_state, upsert_in_state
from siltline.streaming.target import KeyedTable


def test_state_survives_a_crash_and_a_restart(spark, monkeypatch):
    root = scratch(spark, "state")
    events = random_events(31, count=160, keys=6)
    write_parts(spark, events, f"{root}/feed", 4)
    log = RowLog(spark, f"{root}/log", KEYS)

    # the third epoch dies after its rows are written and before they count
    real, calls = statestore.publish_text, []

    def dying(session, path, text):
        calls.append(path[-17:-5])
        if len(calls) == 3:
            raise RuntimeError("executor went away")
        real(session, path, text)

    monkeypatch.setattr(statestore, "publish_text", dying)

    def once():
        stream = folder_feed(spark, f"{root}/feed", files_per_trigger=1)
        upsert_in_state(stream, log, f"{root}/checkpoint").awaitTermination()

    with pytest.raises(Exception, match="executor went away"):
        once()
    once()
    assert [int(c) for c in calls] == [0, 1, 2, 2, 3]
    assert rows_of(log.read()) == expected(events)

    # late events after a compaction, same checkpoint: state remembers the order of what the log no longer tells
    log.compact()
    assert len(log._notes()) == 1 and rows_of(log.read()) == expected(events)
    late = random_events(32, count=20, keys=6)
    write_parts(spark, late, f"{root}/feed", 1)
    once()
    assert len(log._notes()) == 2
    assert rows_of(log.read()) == expected(events + late)


def test_an_epoch_counts_once(spark):
    log = RowLog(spark, f"{scratch(spark, 'log')}/log", ["k"])
    with pytest.raises(ValueError, match="no rows yet"):
        log.read()
    log.append(spark.sql("SELECT 1 AS k, 'a' AS v"), 0)
    log.append(spark.sql("SELECT 1 AS k, 'b' AS v"), 0)
    log.append(spark.sql("SELECT 1 AS k, cast(null AS string) AS v UNION ALL SELECT null, 'n'"), 1)
    log.append(spark.sql("SELECT 1 AS k, 'a' AS v").where("false"), 2)
    assert {tuple(r) for r in log.read().collect()} == {(1, None), (None, "n")}


def test_maps_are_refused(spark):
    events = frame(spark, random_events(33, count=5)).selectExpr("*", "map(1, a) AS m")
    with pytest.raises(ValueError, match="cannot fold: \\['m'\\]"):
        latest_in_state(events, KEYS)


@pytest.mark.parametrize("stop", ["before the load", "after the load", "never"])
def test_hand_over_loses_and_repeats_nothing(spark, sf_dir, monkeypatch, stop):
    root = scratch(spark, "hand over, with spaces")
    spec, conform = contract.ACTIVITY, {"tie": contract.TIE, **contract.LOAD}
    feeds = {"main": contract.main_feed(spark, sf_dir), "recon": contract.recon_feed(spark, sf_dir)}

    def add(part):
        for name, feed in feeds.items():
            feed.where(f"event_id % 3 = {part}").repartition(3).write.mode("append").parquet(f"{root}/{name}")

    add(0)
    split = [SplitFeed(spark, f"{root}/{n}", f"{root}/first/{n}.json") for n in feeds]
    assert [len(s.files()) for s in split] == [3, 3]
    add(1)
    table = KeyedTable(spark, f"{root}/table", spec.keys, buckets=2, splits=1)

    def once():
        load_then_stream(spec, *split, table, f"{root}/checkpoint", **conform).awaitTermination()

    if stop != "never":
        with monkeypatch.context() as patch:
            def dying(*_, **__):
                raise RuntimeError("driver went away")

            if stop == "before the load":
                patch.setattr(KeyedTable, "merge", dying)
            else:
                patch.setattr("siltline.streaming.handover.start_entity", dying)
            with pytest.raises(RuntimeError, match="driver went away"):
                once()
        assert (FIRST_LOAD in table.layout().epochs) == (stop == "after the load")
    once()
    add(2)
    once()
    every = change_events(spec, feeds["main"], feeds["recon"], **conform)
    assert sum(r.events for r in table.commits().collect()) == every.where("__seq IS NOT NULL").count()
    names = [*spec.target_columns]
    want = upsert(every, spec.keys).select(*names)
    got = table.read().select(*names)
    assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()


def test_files_of_the_first_load_are_not_read_again(spark):
    root = scratch(spark, "pruned")
    write_parts(spark, random_events(34, count=40), f"{root}/feed", 4)
    split = SplitFeed(spark, f"{root}/feed", f"{root}/first.json")
    assert len(split.files()) == 4
    seen = []
    query = split.stream().writeStream.foreachBatch(lambda batch, _: seen.append((len(batch.inputFiles()), batch.count())))
    query = query.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [n for _, n in seen] == [0]
    assert query.lastProgress["sources"][0]["numInputRows"] == 0
