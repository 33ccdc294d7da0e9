"""The physical plans the engine relies on."""

import re

import pytest
from scenarios import KEYS, frame, main

from siltline.functions.columns import key_slot
from siltline.operators import upsert as upserts
from siltline.operators.changes import change_feed
from siltline.operators.conform import change_events, conform_recon
from siltline.operators.state import absorb
from siltline.operators.upsert import condense_hot_keys, current, hot_keys, upsert
from siltline.plans import contract
from siltline.plans import entities as E
from siltline.plans.derived import entity_feed, entity_recon_feed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_fold_is_one_shuffle_and_one_window(spark, sf_dir):
    events = change_events(E.ASSETS, entity_feed(spark, sf_dir, E.ASSETS), entity_recon_feed(spark, sf_dir, E.ASSETS))
    text = plan(current(events, E.ASSETS.keys))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert len(re.findall(r"\+- Window ", text)) == 1
    assert "Python" not in text


def test_no_hot_key_leaves_one_shuffle_and_no_join(spark, sf_dir):
    text = final_plan(upsert(contract.activity_events(spark, sf_dir), contract.ACTIVITY.keys, fold_columns=0))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "Join" not in text


def test_few_columns_are_folded_before_the_shuffle(spark, sf_dir):
    """One scan, one exchange, partial aggregates and no window, whatever the keys are."""
    events = contract.activity_events(spark, sf_dir)
    for keys in (contract.ACTIVITY.keys, ("EVENT_TYPE",)):
        text = final_plan(upsert(events, keys))
        assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
        assert "partial_max" in text and "Window" not in text and "Join" not in text
        assert len(re.findall(r"Scan parquet", text)) == 2  # the two feeds, once each


def test_maps_are_not_folded(spark):
    rows = spark.createDataFrame([(1, {"a": 1}, 1, 0, 1, 1), (1, None, 2, 0, 2, 2)], "k int, m map<string,int>, __seq int, __flow int, __arrival int, __tie long")
    assert "Window" in plan(upsert(rows, ["k"]))
    assert [tuple(r) for r in upsert(rows, ["k"]).collect()] == [(1, {"a": 1})]


def test_hot_key_is_split_before_the_shuffle_by_key(spark):
    rows = [main("10:00", "x", i, tie=i) for i in range(400)]
    text = final_plan(upsert(frame(spark, rows), KEYS, hot_rows=50, fold_columns=0))
    assert "BroadcastHashJoin" in text and "__part" in text


def test_many_keys_in_few_slots_are_not_hot(spark, monkeypatch):
    monkeypatch.setattr(upserts, "HOT_SLOTS", 4)
    rows = [main("10:00", "x", i, key=(1, i), tie=i) for i in range(400)]
    text = final_plan(upsert(frame(spark, rows), KEYS, hot_rows=50, fold_columns=0))  # each slot is far above the limit, no key is
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1 and "Join" not in text


def test_dealing_does_not_depend_on_row_order(spark):
    text = plan(condense_hot_keys(frame(spark, [main("10:00", "x")]), KEYS))
    assert "monotonically_increasing_id" not in text and "SPARK_PARTITION_ID" in text


def test_change_feed_is_one_shuffle(spark):
    old = spark.range(40).selectExpr("id AS k", "id % 3 AS v")
    new = spark.range(30, 60).selectExpr("id AS k", "id % 2 AS v")
    assert len(re.findall(r"Exchange hashpartitioning", plan(change_feed(old, new, ["k"])))) == 1


def test_search_for_hot_keys_reads_keys_and_sequence_only(spark, sf_dir):
    events = contract.activity_events(spark, sf_dir)
    text = plan(hot_keys(events.where("__seq IS NOT NULL"), contract.ACTIVITY.keys))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert scans and all("value" not in s and "props" not in s for s in scans)


@pytest.mark.parametrize("columns", [["ACTIVE_FLAG"], ["INSTANCE", "DT_REMOVED"]])
def test_views_prune_the_scan(spark, sf_dir, columns):
    view = conform_recon(entity_recon_feed(spark, sf_dir, E.ASSETS), E.ASSETS).select(*columns)
    assert "value" not in plan(view) and "props" not in plan(view)


def test_wide_feeds_of_one_row_group_are_made_by_all_cores(spark, sf_dir):
    """The narrow rows are dealt below the projection that widens them."""
    text = plan(entity_feed(spark, sf_dir, E.WORK_PACKAGE_DETAILS))
    dealt = text.index("Exchange RoundRobinPartitioning(4)")
    assert text.index("Project") < dealt < text.index("FileScan")


@pytest.mark.parametrize(("given", "want"), [("65535", "8000"), ("5000", "5000")])
def test_queries_run_with_methods_that_the_jvm_compiles(spark, sf_dir, given, want):
    """Whatever session they are given; a limit of the session's own stays."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, given)
    try:
        contract.queries()["conform_work_package_details"](spark, sf_dir)
        assert spark.conf.get(limit) == want
    finally:
        spark.conf.set(limit, before)


def test_the_wide_window_of_a_merge_sees_survivors_only(spark):
    rows = frame(spark, [main("10:00", "x", i, tie=i) for i in range(40)])
    text = plan(absorb(None, rows, KEYS, bucket=key_slot(KEYS, 4)))
    windows = [m.start() for m in re.finditer(r"Window \[", text)]
    assert len(windows) == 2 and "Filter" in text[windows[0] : windows[1]]
    assert "nth_value" not in text  # a frame of its own for every column
    assert len(re.findall(r"Exchange ", text)) == 1 and len(re.findall(r"Sort \[", text)) == 1


def test_a_merge_sorts_and_shuffles_its_values_as_one_block(spark):
    """Eight bytes of the first sort column tell keys apart, and no operator before the wide window copies single columns."""
    rows = frame(spark, [main("10:00", "x", i, tie=i) for i in range(40)])
    text = plan(absorb(None, rows, KEYS, bucket=key_slot(KEYS, 4)))
    assert re.search(r"Sort \[__place#", text)
    narrow = text[[m.start() for m in re.finditer(r"Window \[", text)][1] : text.index("Exchange ")]
    assert "__row#" in narrow and not re.search(r"\b(a|b|ACTIVE_FLAG|DT_REMOVED)#", narrow)
