"""The contract queries written a second time, as plain SQL for DuckDB.

The operators are written anew: the upsert is one ``arg_max(column, order) FILTER (column is not null)`` per column.
What is shared are the feed definitions (which stand for input data) and what an entity declares: names, casts, keys,
sequence and removal rule. The tests hold those declarations against lists of their own.
"""

from siltline.plans.derived import (
    ACTIVITY_KEYS,
    entity_columns,
    key_columns,
    main_columns,
    recon_columns,
)
from siltline.plans.entities import ENTITIES, WORK_PACKAGE_WORKFLOW_LISTS
from siltline.plans.spec import EntitySpec, Null

LOAD_TIME = "TIMESTAMP '2024-01-15 00:00:00'"
LINEAGE = ["_ingested_at", "_source_system", "_source_table"]


def back(seconds):
    return f"(ts - to_seconds({seconds}))"


def listed(columns):
    return ", ".join(f"{sql} AS {name}" for name, sql in columns)


def latest(column):
    return f"arg_max({column}, ord) FILTER (WHERE {column} IS NOT NULL) AS {column}"


def fold(keys, columns, source="ev"):
    return f"SELECT {', '.join(keys)}, {', '.join(latest(c) for c in columns)} FROM {source} GROUP BY ALL"


MAIN = f"main AS (SELECT {listed(main_columns(back))} FROM events)"
RECON = f"recon AS (SELECT {listed(recon_columns(ACTIVITY_KEYS))} FROM events)"
K2 = ["EVENT_TYPE", "USER_ID"]
K3 = [*K2, "PART"]
SHOWN = ["VAL", "PROPS", "ACTIVE_FLAG", "DT_REMOVED", "_ingested_at"]
SEQ2 = "coalesce(RecordLastModified, _ingested_at)"


def main_events(keys=K2, seq=SEQ2):
    return f"""SELECT {", ".join(f"{k} AS {k}" for k in keys)}, val AS VAL, props AS PROPS, dtRemoved IS NULL AS ACTIVE_FLAG,
        dtRemoved AS DT_REMOVED, _ingested_at, row({seq}, 0, _ingested_at, event_id) AS ord FROM main"""


def recon_events(keys=K2, shift=0):
    chosen = ", ".join(f"{k} + {shift} AS {k}" if k == "USER_ID" else f"{k} AS {k}" for k in keys)
    return f"""SELECT {chosen}, NULL::DOUBLE AS VAL, NULL::VARCHAR AS PROPS,
        CASE WHEN hard_delete THEN false END AS ACTIVE_FLAG, dt_removed AS DT_REMOVED,
        NULL::TIMESTAMP AS _ingested_at, row(ingested_at, 1, ingested_at, event_id) AS ord FROM recon"""


def activity(keys=K2, recon=True, shift=0, seq=SEQ2):
    parts = main_events(keys, seq)
    if recon:
        parts += f" UNION ALL {recon_events(keys, shift)}"
    return f"WITH {MAIN}, {RECON}, ev AS ({parts})"


# ---- entities


def _view_columns(spec: EntitySpec):
    out = []
    for c in spec.columns:
        if isinstance(c, Null):
            out.append((c.target, f"CAST(NULL AS {c.cast})"))
        elif c.cast:
            out.append((c.target, f"CAST({c.name} AS {c.cast})"))
        else:
            out.append((c.target, c.name))
    out.append(("ACTIVE_FLAG", f"{spec.removed_by} IS NULL" if spec.removed_by else "true"))
    out.append(("LOADED_BY", "'loader'"))
    out.append(("DH_EFF_DT", "_ingested_at"))
    out += [(c.target, f"CAST(NULL AS {c.cast})") for c in spec.audit_nulls]
    return [*out, *[(c, c) for c in LINEAGE]]


def _sequence(spec: EntitySpec):
    return f"coalesce({', '.join(spec.sequence)})" if spec.sequence else LOAD_TIME


def _text(columns, decimals):
    """Decimals are compared as exact text."""
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in decimals else c for c in columns)


def _decimals(spec):
    return {c.target for c in spec.columns if (c.cast or "").startswith("decimal")}


def conform_sql(spec: EntitySpec):
    columns = _view_columns(spec) + [("load_timestamp", LOAD_TIME)]
    if spec.sequence:
        columns.append(("_scd_sequence", _sequence(spec)))
    names = [n for n, _ in columns] + ["event_id"]
    return f"""WITH feed AS (SELECT {listed(entity_columns(spec, back))} FROM events),
        view AS (SELECT {listed(columns)}, event_id FROM feed)
        SELECT {_text(names, _decimals(spec))} FROM view"""


def conform_recon_sql(spec: EntitySpec):
    keys = ", ".join(f"{k.name} AS {k.target}" for k in spec.key_sources)
    order = "ingested_at AS _scd_sequence, " + LOAD_TIME + " AS load_timestamp"
    if not spec.sequence:
        order = "ingested_at AS load_timestamp"
    return f"""WITH recon AS (SELECT {listed(recon_columns(key_columns(spec)))} FROM events)
        SELECT {keys}, CASE WHEN hard_delete THEN false END AS ACTIVE_FLAG, dt_removed AS DT_REMOVED,
        {order}, event_id FROM recon"""


def entity_events(spec: EntitySpec):
    columns = _view_columns(spec)
    keys = ", ".join(f"{k.name} AS {k.target}" for k in spec.key_sources)
    return f"""WITH feed AS (SELECT {listed(entity_columns(spec, back))} FROM events),
        recon AS (SELECT {listed(recon_columns(key_columns(spec)))} FROM events),
        ev AS (
            SELECT {listed(columns)}, row({_sequence(spec)}, 0, _ingested_at, event_id) AS ord FROM feed
            UNION ALL BY NAME
            SELECT {keys}, CASE WHEN hard_delete THEN false END AS ACTIVE_FLAG, dt_removed AS DT_REMOVED,
            row(ingested_at, 1, ingested_at, event_id) AS ord FROM recon)"""


def entity_sql(spec: EntitySpec):
    names = [n for n, _ in _view_columns(spec)]
    names = list(dict.fromkeys([*names, "DT_REMOVED"]))
    rest = [n for n in names if n not in spec.keys]
    result = fold(spec.keys, rest)
    return f"{entity_events(spec)}, result AS ({result}) SELECT {_text(names, _decimals(spec))} FROM result"


def entity_counts(specs):
    parts = [
        f"""SELECT '{s.target}' AS target, count(DISTINCT ({", ".join(k.name for k in s.key_sources)})) AS rows,
        2 * count(*) AS events, 0 AS rejected FROM (SELECT {listed(entity_columns(s, back))} FROM events)"""
        for s in specs
    ]
    return " UNION ALL ".join(parts)


# ---- single operators


def simple(feed, select):
    return f"WITH {MAIN}, {RECON} SELECT {select} FROM {feed}"


WEEKS = ("2024-01-08", "2024-01-15", "2024-01-22")


def change_feed(start="2024-01-15"):
    kept = ["VAL", "ACTIVE_FLAG", "DT_REMOVED"]
    row = lambda side: ", ".join(f"{side}.{c} AS {c}" for c in [*K2, *kept])
    same = " AND ".join(f"o.{k} IS NOT DISTINCT FROM n.{k}" for k in K2)
    differ = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in kept)
    both = f"FROM old o JOIN new n ON {same} WHERE {differ}"
    return f"""{activity()},
        cut AS (SELECT * FROM ev WHERE ord[3] < TIMESTAMP '{start} 00:00:00'),
        old AS ({fold(K2, kept, "cut")}), new AS ({fold(K2, kept)})
        SELECT {row("n")}, 'insert' AS _change_type FROM new n ANTI JOIN old o ON {same}
        UNION ALL SELECT {row("o")}, 'update_preimage' {both}
        UNION ALL SELECT {row("n")}, 'update_postimage' {both}"""


def active_rows_by_type():
    """A recount of the state after each week."""
    parts = []
    for i, end in enumerate((*WEEKS, "2100-01-01"), 1):
        state = fold(K2, ["ACTIVE_FLAG", "DT_REMOVED"], f"(SELECT * FROM ev WHERE ord[3] < TIMESTAMP '{end} 00:00:00')")
        parts.append(
            f"SELECT EVENT_TYPE, ACTIVE_FLAG, count(*) AS rows, count(DT_REMOVED) AS removed,"
            f" CAST(sum(USER_ID) AS BIGINT) AS user_sum, {i} AS commit FROM ({state}) GROUP BY ALL"
        )
    return f"{activity()} {' UNION ALL '.join(parts)}"


def cast_rejects():
    faults = {"HOURS": "event_id % 4 = 0", "CODE": "event_id % 7 = 0", "_scd_sequence": "RecordLastModified IS NULL"}
    names = ", ".join(f"CASE WHEN {fault} THEN '{name}' END" for name, fault in faults.items())
    return simple("main", f"event_id, concat_ws(',', {names}) AS reasons") + f" WHERE {' OR '.join(faults.values())}"


def upsert_without_rejects():
    good = main_events().replace(" FROM main", ", CAST(event_id AS DOUBLE) AS HOURS, event_id AS CODE FROM main")
    good += " WHERE event_id % 4 <> 0 AND event_id % 7 <> 0"
    return f"WITH {MAIN}, ev AS ({good}) {fold(K2, ['HOURS', 'CODE', 'VAL'])}"


def recon_from_snapshots():
    keys, cut = ", ".join(K3), "TIMESTAMP '2024-01-15 00:00:00'"
    seen = lambda when: f"SELECT {keys} FROM main WHERE _ingested_at {when} {cut}"
    gone = f"""SELECT {keys}, NULL::DOUBLE AS VAL, NULL::VARCHAR AS PROPS, false AS ACTIVE_FLAG,
        TIMESTAMP '2024-02-01' AS DT_REMOVED, NULL::TIMESTAMP AS _ingested_at,
        row(TIMESTAMP '2024-02-01', 1, TIMESTAMP '2024-02-01', 0::BIGINT) AS ord
        FROM ({seen("<")} EXCEPT {seen(">=")})"""
    return f"WITH {MAIN}, ev AS ({main_events(K3)} UNION ALL {gone}) {fold(K3, SHOWN)}"


def table_type_growth():
    by_part = lambda *values: f"CASE event_id % 3 WHEN 0 THEN {values[0]} WHEN 1 THEN {values[1]} ELSE {values[2]} END"
    single = "CAST(CAST(user_id AS DOUBLE) / 7 AS FLOAT)"
    grown = {
        "COUNT": by_part("event_id % 1000000", "event_id + 5000000000", "event_id % 100"),
        "RATIO": by_part(f"CAST({single} AS DOUBLE)", "CAST(user_id AS DOUBLE) / 8", f"CAST({single} AS DOUBLE)"),
        "PRICE": f"CAST({by_part('event_id % 1000 + 0.25', 'event_id % 100000 + 0.0625', 'NULL')} AS DECIMAL(12,4))",
    }
    added = ", ".join(f"{sql} AS {name}" for name, sql in grown.items())
    events = main_events().replace("props AS PROPS", "CASE WHEN event_id % 3 <> 2 THEN props END AS PROPS")
    events = events.replace(" FROM main", f", {added} FROM main")
    result = f"result AS ({fold(K2, [*grown, 'PROPS', 'ACTIVE_FLAG'])})"
    return f"WITH {MAIN}, ev AS ({events}), {result} SELECT * REPLACE (CAST(PRICE AS VARCHAR) AS PRICE) FROM result"


def line_latest():
    columns = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    columns += ["l_returnflag", "l_linestatus", "l_shipdate"]
    order = "row(l_shipdate, floor(l_extendedprice * 100), l_partkey * 1000000 + l_suppkey)"
    return f"WITH ev AS (SELECT *, {order} AS ord FROM lineitem) {fold(['l_orderkey', 'l_linenumber'], columns)}"


def oracle_sql() -> dict[str, str]:
    two_flow = f"{activity()} {fold(K2, SHOWN)}"
    workflow = WORK_PACKAGE_WORKFLOW_LISTS
    names = [*K2, "VAL", "PROPS", "DT_REMOVED", "ACTIVE_FLAG", "_ingested_at"]
    audit = ["LOADED_BY", "DH_EFF_DT", "_source_system", "_source_table"]
    known = " UNION ALL ".join(
        [f"SELECT '{c}' AS column_name, count({c}) AS known_rows FROM result" for c in names]
        # audit columns come with every main event, so they are known for every key the main feed has
        + [f"SELECT '{c}' AS column_name, count(_ingested_at) AS known_rows FROM result" for c in audit]
    )
    sql = {
        "cast_double": """SELECT o_orderkey, CAST(CAST(o_orderkey AS VARCHAR) || '.25' AS DOUBLE) AS manhours
            FROM orders""",
        "cast_decimal_38_12": """SELECT o_orderkey, CAST(CAST(CAST(o_orderkey + 1 AS VARCHAR) || '.125'
            AS DECIMAL(38,12)) AS VARCHAR) AS list_price FROM orders""",
        "cast_bigint": """SELECT l_orderkey, l_linenumber,
            CAST(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS BIGINT) AS order_sequence FROM lineitem""",
        "cast_or_null": """SELECT event_id, TRY_CAST(CASE WHEN event_id % 4 = 0 THEN 'n/a'
            ELSE CAST(event_id AS VARCHAR) END AS DOUBLE) AS manhours FROM events""",
        "cast_failures": """SELECT 'HOURS' AS column_name, count(*) AS failed FROM events WHERE event_id % 4 = 0
            UNION ALL SELECT 'CODE', count(*) FROM events WHERE event_id % 7 = 0""",
        "cast_rejects": cast_rejects(),
        "upsert_without_rejects": upsert_without_rejects(),
        "recon_from_snapshots": recon_from_snapshots(),
        "soft_delete_flag": simple("main", "event_id, dtRemoved IS NULL AS active_flag"),
        "recon_flag": simple("recon", "event_id, CASE WHEN hard_delete THEN false END AS active_flag"),
        "seq_coalesce2": simple("main", f"event_id, {SEQ2} AS seq"),
        "seq_coalesce3": simple("main", "event_id, coalesce(StateDate, ResourceStateDate, _ingested_at) AS seq"),
        "upsert_latest": f"{activity(recon=False)} {fold(K2, SHOWN)}",
        "upsert_three_keys": f"{activity(K3, recon=False)} {fold(K3, SHOWN)}",
        "upsert_ignore_nulls": f"{activity(recon=False)} {fold(K2, ['VAL', 'PROPS'])}",
        "upsert_out_of_order": f"{activity(recon=False)} {fold(K2, SHOWN)}",
        "upsert_processing_time_ties": f"{activity(seq=LOAD_TIME)} {fold(K2, SHOWN)}",
        "two_flow_upsert": two_flow,
        "stream_two_flow_upsert": two_flow,
        "state_store_upsert": two_flow,
        "hand_over_upsert": two_flow,
        "upsert_hot_keys": f"{activity(['EVENT_TYPE'])} {fold(['EVENT_TYPE'], SHOWN)}",
        "upsert_map_side": f"{activity(['EVENT_TYPE'])} {fold(['EVENT_TYPE'], SHOWN)}",
        "recon_stub_rows": f"{activity(shift=100000)} {fold(K2, SHOWN)}",
        "reactivation_sticky_removed": f"""{activity()}, result AS ({fold(K2, SHOWN)})
            SELECT * FROM result WHERE ACTIVE_FLAG AND DT_REMOVED IS NOT NULL""",
        "upsert_default_tie": f"""WITH {MAIN}, ev AS (SELECT event_type, user_id, val, props, _ingested_at,
            row(_ingested_at, event_id) AS ord FROM main) {fold(["event_type", "user_id"], ["val", "props", "_ingested_at"])}""",
        "table_schema_growth": f"""{activity(recon=False).replace("props AS PROPS", "CASE WHEN event_id % 3 = 1 THEN props END AS PROPS")}
            {fold(K2, SHOWN)}""",
        "table_type_growth": table_type_growth(),
        "main_behind_recon": f"""{activity().replace("FROM recon", "FROM recon WHERE event_id % 4 = 0")}, result AS ({fold(K2, SHOWN)}),
            last AS (SELECT EVENT_TYPE, USER_ID FROM ev GROUP BY ALL HAVING max(ord)[2] = 1)
            SELECT * FROM result SEMI JOIN last USING (EVENT_TYPE, USER_ID)""",
        "workflow_only_recon_deactivates": f"""{entity_events(workflow)},
            result AS ({fold(workflow.keys, ["PROJECT", "ACTIVE_FLAG", "DT_REMOVED"])})
            SELECT * FROM result WHERE NOT ACTIVE_FLAG""",
        "except_columns": f"{activity()}, result AS ({fold(K2, SHOWN)}) {known}",
        "change_feed": change_feed(),
        "table_change_feed": change_feed(),
        "stream_change_feed": change_feed(),
        "net_change_feed": change_feed(WEEKS[0]),
        "active_rows_by_type": active_rows_by_type(),
        "null_sequence_rejects": simple("main", "event_type AS EVENT_TYPE, user_id AS USER_ID, event_id")
        + " WHERE RecordLastModified IS NULL",
        "conversation_latest": """SELECT conv_id, max(turn) AS turn,
            arg_max(role, turn) FILTER (WHERE role IS NOT NULL) AS role,
            arg_max(text, turn) FILTER (WHERE text IS NOT NULL) AS text FROM conversations GROUP BY conv_id""",
        "document_latest": """SELECT lang, source, max(doc_id) AS doc_id,
            arg_max(text, doc_id) FILTER (WHERE text IS NOT NULL) AS text,
            arg_max(n_chars, doc_id) FILTER (WHERE n_chars IS NOT NULL) AS n_chars
            FROM documents GROUP BY lang, source""",
        "line_latest": line_latest(),
        "customer_latest_order": "WITH ev AS (SELECT *, row(o_orderdate, o_orderkey) AS ord FROM orders) "
        + fold(["o_custkey"], ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]),
        "pipeline_row_counts": entity_counts(ENTITIES),
    }
    for spec in ENTITIES:
        sql[f"conform_{spec.name}"] = conform_sql(spec)
        sql[f"conform_recon_{spec.name}"] = conform_recon_sql(spec)
        sql[f"entity_{spec.name}"] = sql[f"stream_{spec.name}"] = entity_sql(spec)
    return sql
