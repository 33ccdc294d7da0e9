from dataclasses import replace
from datetime import datetime
from decimal import Decimal

import pytest
from bronze import lineage, main_feed, recon_feed
from scenarios import at

from siltline.functions.naming import upper_snake
from siltline.operators.conform import as_events, change_events, conform_main, conform_recon, recon_from_snapshots
from siltline.operators.upsert import ORDER, split_rejects, upsert
from siltline.sources.workspace import scratch
from siltline.streaming.target import KeyedTable
from siltline.plans import entities as E
from siltline.plans.spec import EntitySpec, Null, Source, named

# name: (main columns, target columns, distinct source columns, keys)
SHAPES = {
    "projects": (12, 12, 8, 2),
    "assets": (87, 85, 81, 3),
    "work_packages": (113, 111, 107, 2),
    "work_packages_steps": (98, 96, 92, 3),
    "work_package_details": (93, 91, 87, 2),
    "work_package_workflow_lists": (24, 22, 17, 3),
    "tasks_tests_planned_details": (133, 131, 127, 2),
    "task_step_instance_details": (62, 60, 57, 3),
}


@pytest.mark.parametrize("spec", E.ENTITIES, ids=lambda s: s.name)
def test_shape(spark, spec):
    shape = (len(spec.main_columns), len(spec.target_columns), len(spec.source_columns), len(spec.keys))
    assert shape == SHAPES[spec.name]
    main, recon = main_feed(spark, spec, []), recon_feed(spark, spec, [])
    assert conform_main(main, spec).columns == list(spec.main_columns)
    recon_columns = [*spec.keys, "ACTIVE_FLAG", "DT_REMOVED", spec.sequence_column]
    recon_columns += ["load_timestamp"] if spec.sequence else []
    assert conform_recon(recon, spec).columns == recon_columns
    events = change_events(spec, main, recon)
    assert events.columns == [*spec.target_columns, *ORDER]
    assert not set(spec.excluded) & set(upsert(events, spec.keys).columns)
    types = dict(events.dtypes)
    assert types["ACTIVE_FLAG"] == "boolean" and types["DT_REMOVED"] == "timestamp"


@pytest.mark.parametrize(
    "name, want",
    [
        ("ProcessBreakdownUp1Id", "PROCESS_BREAKDOWN_UP1_ID"),
        ("ElectricalSourceMCCNumber", "ELECTRICAL_SOURCE_MCC_NUMBER"),
        ("SAPMaterialCode", "SAP_MATERIAL_CODE"),
        ("Image2ID", "IMAGE2_ID"),
        ("StatusRGBColor", "STATUS_RGB_COLOR"),
        ("StepAnswerNCId", "STEP_ANSWER_NC_ID"),
        ("dtRemoved", "DT_REMOVED"),
        ("Field001", "FIELD001"),
        ("FIWP", "FIWP"),
        ("IsNA", "IS_NA"),
        ("IsNa", "IS_NA"),
        ("WorkPackageDetails_Id", "WORK_PACKAGE_DETAILS_ID"),
        ("_ingested_at", "_ingested_at"),
    ],
)
def test_naming_rule(name, want):
    assert upper_snake(name) == want


def test_names_set_by_hand():
    targets = lambda spec: {c.name: c.target for c in spec.columns if isinstance(c, Source)}
    for spec in E.ENTITIES:
        assert targets(spec)["Instances_Id"] == "INSTANCE"
    assert targets(E.WORK_PACKAGES_STEPS)["WorkPackages_Id"] == "WORK_PACKAGES__ID"
    assert targets(E.WORK_PACKAGES_STEPS)["WVUoM"] == "WV_UOM"
    assert targets(E.TASK_STEP_INSTANCE_DETAILS)["Projects_Id"] == "PROJECT"
    for spec in (E.ASSETS, E.WORK_PACKAGES, E.WORK_PACKAGES_STEPS, E.WORK_PACKAGE_DETAILS, E.TASKS_TESTS_PLANNED_DETAILS):
        both = [c.target for c in spec.columns if getattr(c, "name", "") == "WorkBreakdownUp3Id"]
        assert both == ["PROJECT", "WORK_BREAKDOWN_UP3_ID"]


def test_casts_and_audit_block(spark):
    row = {"Instances_Id": 1, "AssetId": 2, "WorkBreakdownUp3Id": 3, "ListPrice": "12.5", **lineage("10:00")}
    feed = main_feed(spark, E.ASSETS, [row, {**row, "dtRemoved": at("09:00"), "RecordLastModified": at("09:30")}])
    live, gone = conform_main(feed, E.ASSETS, load_user="me", load_time="2024-02-01 00:00:00").collect()
    assert live.LIST_PRICE == Decimal("12.500000000000")
    assert (live.PROJECT, live.WORK_BREAKDOWN_UP3_ID) == (3, 3)
    assert (live.ACTIVE_FLAG, gone.ACTIVE_FLAG) == (True, False)
    assert live.DH_EFF_DT == live["_ingested_at"] == at("10:00")
    assert (live["_scd_sequence"], gone["_scd_sequence"]) == (at("10:00"), at("09:30"))
    assert (live.LOADED_BY, live["load_timestamp"]) == ("me", datetime(2024, 2, 1))
    assert live["_source_system"] == "sys" and live["_source_table"] == "tab"


def test_malformed_numbers_fail_or_become_null(spark):
    row = {"Instances_Id": 1, "Id": 2, "ActualMH": "n/a", "BudgetMH": "2.5", **lineage("10:00")}
    feed = main_feed(spark, E.WORK_PACKAGES, [row])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform_main(feed, E.WORK_PACKAGES).collect()
    got = conform_main(feed, E.WORK_PACKAGES, on_cast_error="null").first()
    assert (got.ACTUAL_MH, got.BUDGET_MH) == (None, 2.5)


def test_session_user_and_clock_by_default(spark):
    feed = main_feed(spark, E.PROJECTS, [{"Instances_Id": 1, "Id": 2, **lineage("10:00")}])
    got = conform_main(feed, E.PROJECTS).first()
    assert got.LOADED_BY == spark.sql("select session_user()").first()[0]
    assert abs((got["load_timestamp"] - spark.sql("select current_timestamp()").first()[0]).total_seconds()) < 120


def test_tie_sees_null_positions(spark):
    base = {"Instances_Id": 1, "Id": 2, **lineage("10:00")}
    feed = main_feed(spark, E.PROJECTS, [{**base, "ProjectName": "a"}, {**base, "Summary": "a"}])
    events = change_events(E.PROJECTS, feed, load_user="u", load_time="2024-01-01 00:00:00")
    assert events.select("__tie").distinct().count() == 2


def merged(spark, spec, main_rows, recon_rows, **options):
    events = change_events(spec, main_feed(spark, spec, main_rows), recon_feed(spark, spec, recon_rows), **options)
    return upsert(events, spec.keys).collect()


def test_t10_workflow_lists_go_inactive_by_recon_only(spark):
    spec = E.WORK_PACKAGE_WORKFLOW_LISTS
    key = {"Instances_Id": 1, "WorkPackageDetails_Id": 5, "Id": 10}
    older = {**key, "StateDate": at("10:30"), "StateComment": "late", **lineage("12:00")}
    first = {**key, "StateDate": at("10:00"), "StateComment": "first", **lineage("10:00")}
    removal = {**key, "hard_delete": True, "dt_removed": at("10:59"), "ingested_at": at("11:00")}
    (row,) = merged(spark, spec, [first, older], [removal])
    assert (row.ACTIVE_FLAG, row.DT_REMOVED, row.STATE_COMMENT) == (False, at("10:59"), "late")
    assert row.PROJECT is None  # T13


def test_t11_projects_processed_after_a_recon_come_back(spark):
    key = {"Instances_Id": 1, "Id": 10}
    removal = {**key, "hard_delete": True, "dt_removed": at("09:59"), "ingested_at": at("10:00")}
    project = {**key, "ProjectName": "p", **lineage("09:00")}
    (row,) = merged(spark, E.PROJECTS, [project], [removal], load_time="2024-01-01 10:05:00")
    assert (row.ACTIVE_FLAG, row.DT_REMOVED) == (True, at("09:59"))
    # ordering projects by ingestion instead is a matter of the spec
    safe = replace(E.PROJECTS, sequence=("_ingested_at",))
    (row,) = merged(spark, safe, [project], [removal], load_time="2024-01-01 10:05:00")
    assert row.ACTIVE_FLAG is False


def test_t12_equal_processing_time_falls_back_to_arrival(spark):
    key = {"Instances_Id": 1, "Id": 10}
    rows = [{**key, "ProjectName": "new", **lineage("10:01")}, {**key, "ProjectName": "old", **lineage("10:00")}]
    (row,) = merged(spark, E.PROJECTS, rows, [], load_time="2024-01-01 12:00:00")
    assert row.PROJECT_NAME == "new"


def test_t13_project_is_a_key_of_step_instances(spark):
    rows = [{"Instances_Id": 1, "Projects_Id": p, "Id": 10, **lineage("10:00")} for p in (1, 2)]
    got = merged(spark, E.TASK_STEP_INSTANCE_DETAILS, rows, [])
    assert sorted(r.PROJECT for r in got) == [1, 2]


def test_a_new_entity_needs_only_a_spec(spark):
    spec = EntitySpec(
        name="rooms",
        keys=("ROOM_ID",),
        columns=(Source("RoomId"), Null("FLOOR", "int"), *named("RoomName Area", {"Area": "double"})),
        removed_by=None,
        sequence=("ChangedAt", "_ingested_at"),
    )
    assert spec.target == "rooms_sql"
    schema = "RoomId bigint, RoomName string, Area string, ChangedAt timestamp, _ingested_at timestamp, "
    schema += "_source_system string, _source_table string"
    feed = spark.createDataFrame([(1, "a", "2.5", None, at("10:00"), "s", "t")], schema)
    row = upsert(change_events(spec, feed), spec.keys).first()
    assert (row.ROOM_ID, row.FLOOR, row.ROOM_NAME, row.AREA, row.ACTIVE_FLAG) == (1, None, "a", 2.5, True)


def test_bad_specs_are_refused():
    with pytest.raises(ValueError, match="produced twice"):
        EntitySpec("x", keys=("ID",), columns=named("Id") + named("Id"))
    with pytest.raises(ValueError, match="not read from the feed"):
        EntitySpec("x", keys=("OTHER",), columns=named("Id"))


def test_reserved_column_names_are_refused_and_others_kept(spark):
    feed = spark.createDataFrame([(1, 5, "I", 2)], "k int, at int, __op string, __slot int")
    with pytest.raises(ValueError, match="__slot"):
        as_events(feed, sequence="at", flow=0, arrival="at")
    events = as_events(feed.drop("__slot"), sequence="at", flow=0, arrival="at")
    assert upsert(events, ["k"]).first().asDict() == {"k": 1, "at": 5, "__op": "I"}


def test_declared_columns_are_those_of_the_statements():
    """Written out, so that a wrong declaration cannot pass by agreeing with itself."""
    assert E.PROJECTS.target_columns == (
        "INSTANCE", "ID", "PROJECT_IDENTIFIER", "PROJECT_NAME", "SUMMARY", "ACTIVE_FLAG", "LOADED_BY", "DH_EFF_DT",
        "_ingested_at", "_source_system", "_source_table", "DT_REMOVED",
    )


MEASURED = EntitySpec(
    name="measured",
    keys=("K",),
    columns=(Source("k"), Source("hours", cast="double"), Source("code", cast="bigint"), Source("name")),
    sequence=("changed",),
    removed_by=None,
)


def measured(spark, rows):
    schema = "k bigint, hours string, code string, name string, changed timestamp, _ingested_at timestamp, _source_system string, _source_table string"
    return spark.createDataFrame([(*r, at("10:00"), "s", "t") for r in rows], schema)


def test_rejects_say_why(spark):
    rows = [
        (1, "1.5", "7", "good", at("10:00")), (2, "n/a", "7", "hours", at("10:00")), (3, "x", "y", "both", at("10:00")),
        (4, None, None, "nulls are no faults", at("10:00")), (5, "2", "8", "late", None), (6, "2", "z", "two", None),
    ]
    events = change_events(MEASURED, measured(spark, rows), on_cast_error="reject")
    good, bad = split_rejects(events)
    assert {(r.K, r.HOURS, r.CODE) for r in good.collect()} == {(1, 1.5, 7), (4, None, None)}
    assert {r.NAME: r.reject_reasons for r in bad.collect()} == {
        "hours": ["HOURS"],
        "both": ["HOURS", "CODE"],
        "late": ["_scd_sequence"],
        "two": ["CODE", "_scd_sequence"],
    }
    for fold_columns in (0, 12):
        assert {r.K for r in upsert(events, MEASURED.keys, fold_columns=fold_columns).collect()} == {1, 4}

    table = KeyedTable(spark, scratch(spark, "rejecting"), MEASURED.keys, buckets=2)
    table.merge(events)
    table.merge(change_events(MEASURED, measured(spark, [(2, "3", "7", "mended", at("11:00"))]), on_cast_error="reject"))
    assert {(r.K, r.HOURS) for r in table.read().collect()} == {(1, 1.5), (2, 3.0), (4, None)}
    assert sorted(r.reject_reasons for r in table.rejects().collect()) == [["CODE", "_scd_sequence"], ["HOURS"], ["HOURS", "CODE"], ["_scd_sequence"]]
    assert set(table.read().columns) == set(MEASURED.target_columns) - {"DT_REMOVED"}  # no reconciliation feed here


def test_reject_mode_without_casts(spark):
    spec = replace(MEASURED, columns=(Source("k"), Source("name")))
    _, bad = split_rejects(change_events(spec, measured(spark, [(1, "x", "y", "n", None)]), on_cast_error="reject"))
    assert [r.reject_reasons for r in bad.collect()] == [["_scd_sequence"]]
    with pytest.raises(ValueError, match="'reject'"):
        change_events(MEASURED, measured(spark, []), on_cast_error="drop")


def test_columns_that_a_feed_lacks(spark):
    full = measured(spark, [(1, "1.5", "7", "a", at("10:00"))])
    with pytest.raises(Exception, match="hours"):
        change_events(MEASURED, full.drop("hours"))
    less = full.drop("hours", "name", "_source_table")
    for mode in ("fail", "reject"):
        events = change_events(MEASURED, less, absent="null", on_cast_error=mode)
        assert "NAME" not in events.columns and events.schema["HOURS"].dataType.simpleString() == "double"
        row = upsert(events, MEASURED.keys).first()
        assert (row.HOURS, row.CODE, row["_source_table"], row["_source_system"]) == (None, 7, None, "s")
    assert upsert(change_events(MEASURED, full, absent="null"), MEASURED.keys).first().NAME == "a"
    assert change_events(MEASURED, full.withColumnRenamed("name", "NaMe"), absent="null").first().NAME == "a"

    # a table keeps what it has
    table = KeyedTable(spark, scratch(spark, "lacking"), MEASURED.keys, buckets=2)
    table.merge(change_events(MEASURED, full))
    later = measured(spark, [(1, None, "8", None, at("11:00"))]).drop("hours", "name")
    table.merge(change_events(MEASURED, later, absent="null"))
    row = table.read().first()
    assert (row.HOURS, row.CODE, row.NAME) == (1.5, 8, "a")

    # what a row's place or state depends on has to be there
    for name in ("k", "changed", "_ingested_at"):
        spec = replace(MEASURED, sequence=("changed",))
        with pytest.raises(ValueError, match=f"measured: the feed lacks .*{name}"):
            change_events(spec, full.drop(name), absent="null")
    with pytest.raises(ValueError, match="dtRemoved"):
        change_events(replace(MEASURED, removed_by="dtRemoved"), full, absent="null")
    either = replace(MEASURED, sequence=("changed", "_ingested_at"))
    assert change_events(either, full.drop("changed"), absent="null").first()["__seq"] == at("10:00")
    with pytest.raises(ValueError, match="absent must be"):
        change_events(MEASURED, full, absent="drop")


def test_reconciliation_from_key_snapshots(spark):
    spec = replace(MEASURED, keys=("K", "NAME"), columns=(Source("k"), Source("name")))
    before = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "c"), (3, "d")], "k bigint, name string")
    after = spark.createDataFrame([(3, "d"), (None, "c"), (9, "new")], "k bigint, name string")
    feed = recon_from_snapshots(before, after, spec, taken_at="2024-01-01 12:00:00")
    assert {(r.k, r.name, r.hard_delete, r.dt_removed, r.ingested_at) for r in feed.collect()} == {
        (1, "a", True, at("12:00"), at("12:00")),
        (2, None, True, at("12:00"), at("12:00")),
    }
    plan = feed.select("*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert recon_from_snapshots(before, before, spec, taken_at="2024-01-01 12:00:00").count() == 0
    # merged like any reconciliation: the row stays, is inactive and knows when it went
    main = measured(spark, [(1, None, None, "a", at("10:00")), (3, None, None, "d", at("10:00"))])
    rows = {r.K: (r.ACTIVE_FLAG, r.DT_REMOVED) for r in upsert(change_events(spec, main, feed), spec.keys).collect() if r.K}
    assert rows == {1: (False, at("12:00")), 3: (True, None), 2: (False, at("12:00"))}
