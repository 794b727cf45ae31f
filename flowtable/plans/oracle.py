"""DuckDB SQL giving the expected result of each verification query on the same tables."""

from __future__ import annotations

_SPLIT = "TIMESTAMP '2024-01-15 00:00:00'"

_CLEAN_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 0
"""

_CLEAN_EVENTS = """
SELECT event_id, user_id, CAST(ts AS TIMESTAMP) AS ts, lower(event_type) AS event_type
FROM events
WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 AND ts IS NOT NULL AND user_id > 0
"""

_SEGMENT_YEARS = """
SELECT c_mktsegment AS segment, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS n_orders, max(o_totalprice) AS top_price
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
"""

_USER_DAYS = """
SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n_events, count(DISTINCT event_type) AS n_types,
       max(value) AS top_value
FROM events GROUP BY user_id, CAST(ts AS DATE)
"""

# events as a run log: times cut to the day, so that event_id breaks ties
_RUNS = """(
  SELECT user_id, event_id, event_type, date_trunc('day', ts) AS day,
         row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC, event_id DESC) AS rn,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY date_trunc('day', ts) DESC, event_id DESC) AS rn_type,
         props || ' ' || repeat('trace ', CAST(event_id % 120 AS INTEGER)) AS props
  FROM events)"""

_HEALTH = f"""
SELECT user_id,
       count(*) AS total_runs,
       count(*) FILTER (WHERE event_type = 'error') AS failures,
       CAST(max(day) AS TIMESTAMP) AS last_run_at,
       max(event_type) FILTER (WHERE rn = 1) AS last_status,
       max(substring(props, 1, 120)) FILTER (WHERE event_type = 'error' AND rn_type = 1) AS last_error
FROM {_RUNS} GROUP BY user_id"""

# a column's type as the loads name it
_TYPE = """CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int'
       ELSE lower(data_type) END"""
_ORDERS_COLUMNS = f"(SELECT column_name, {_TYPE} AS t, column_index FROM duckdb_columns() WHERE table_name = 'orders')"

_TWO_RUNS = f"""
SELECT 'SUCCESS' AS status, count(*) AS rows_extracted, count(*) AS rows_loaded, max(ts) AS high_water_mark
FROM events WHERE ts <= {_SPLIT}
UNION ALL
SELECT 'SUCCESS', count(*), count(*), max(ts) FROM events WHERE ts > {_SPLIT}
"""


def _report_row(name: str, column: str, rule: str, table: str, viol: str, tail: str) -> str:
    return f"""
SELECT '{name}' AS check_name, '{column}' AS column_name, '{rule}' AS rule,
       CAST({viol} AS BIGINT) AS violations, ({viol}) = 0 AS passed,
       CASE WHEN ({viol}) = 0 THEN NULL
            ELSE '{name}: ''{column}'' has ' || CAST({viol} AS VARCHAR) || '{tail}' END AS message
FROM {table}"""


_DQ_REPORT = " UNION ALL ".join(
    [
        _report_row("acctbal_positive", "c_acctbal", "greater_than", "customer",
                    "count(*) FILTER (WHERE c_acctbal <= 0)", " value(s) not greater than 0"),
        _report_row("custkey_present", "c_custkey", "not_null", "customer",
                    "count(*) FILTER (WHERE c_custkey % 9 = 0)", " null value(s)"),
        _report_row("balance_text_positive", "balance_text", "greater_than", "customer",
                    "count(*) FILTER (WHERE c_custkey % 4 <> 0 AND c_acctbal <= 0)", " value(s) not greater than 0"),
        """
SELECT 'column_gone' AS check_name, 'no_such_column' AS column_name, 'not_null' AS rule, CAST(NULL AS BIGINT) AS violations,
       count(*) < 0 AS passed, 'column_gone: column ''no_such_column'' not found in data' AS message
FROM customer""",
        _report_row("orderkey_unique", "l_orderkey", "unique", "lineitem",
                    "count(*) - count(DISTINCT l_orderkey) - coalesce(max(CASE WHEN l_orderkey IS NULL THEN 1 ELSE 0 END), 0)",
                    " duplicate value(s)"),
        _report_row("event_type_is_time", "event_type", "timestamp_format", "events",
                    "count(*) FILTER (WHERE event_id % 3 = 1)", " invalid timestamp(s)"),
    ]
)


def _min_rows(name: str, n: int) -> str:
    return f"""
SELECT '{name}' AS check_name, CAST(NULL AS VARCHAR) AS column_name, 'min_rows' AS rule,
       CAST(greatest({n} - count(*), 0) AS BIGINT) AS violations, count(*) >= {n} AS passed,
       CASE WHEN count(*) >= {n} THEN NULL
            ELSE '{name}: expected at least {n} rows, got ' || CAST(count(*) AS VARCHAR) END AS message
FROM customer"""


_ALERT = (
    "'*Pipeline Failed* ✗' || chr(10) || '*Pipeline:* `' || CAST(user_id AS VARCHAR) || '`' || chr(10) "
    "|| '*Run ID:* `' || CAST(event_id AS VARCHAR) || '`' || chr(10) || '*Error:* ' || coalesce(substring(props || ' ' || repeat('trace ', CAST(event_id % 120 AS INTEGER)), 1, 500), '')"
)

_VERSION_CUT = "TIMESTAMP '1996-01-01 00:00:00'"
# orders whose tracked values are partly missing or hold separators and quotes, and their hash
_VERSIONED = """(
  SELECT o_custkey, o_orderkey, o_orderdate,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 5 = 0 THEN 'a|b "c" \\ d' WHEN o_orderkey % 5 <> 1 THEN o_orderpriority END AS o_orderpriority
  FROM orders)"""
_HASH = "substring(sha256(CAST(to_json({'o_orderpriority': o_orderpriority, 'o_orderstatus': o_orderstatus}) AS VARCHAR)), 1, 16)"

_RUN_ALL = """
SELECT 'customer_feed' AS pipeline_name, 'warehouse-team' AS owner, 'append' AS load_mode, 'SUCCESS' AS status,
       CAST(1 AS BIGINT) AS total_runs, CAST(0 AS BIGINT) AS failures, CAST(count(*) AS BIGINT) AS rows_loaded,
       CAST(NULL AS VARCHAR) AS last_error
FROM customer
UNION ALL
SELECT 'orders_feed', 'warehouse-team', 'overwrite', 'SUCCESS', 1, 0, count(*), NULL FROM orders
UNION ALL
SELECT 'supplier_feed', 'warehouse-team', 'overwrite', 'SUCCESS', 1, 0, count(*), NULL FROM supplier
UNION ALL
SELECT 'zz_balances_feed', 'finance', 'append', 'FAILED', 1, 1, 0,
       substring('Data quality checks failed:' || chr(10) || '  ✗ acctbal_positive: ''c_acctbal'' has '
                 || CAST(count(*) FILTER (WHERE c_acctbal <= 0) AS VARCHAR) || ' value(s) not greater than 0', 1, 120)
FROM customer
"""

ORACLE: dict[str, str] = {
    "clean_orders": _CLEAN_ORDERS,
    "clean_events": _CLEAN_EVENTS,
    "incremental_filter": f"SELECT * FROM events WHERE ts IS NOT NULL AND ts > {_SPLIT}",
    "hwm_per_key": "SELECT event_type, max(ts) AS high_water_mark, count(*) AS n_rows FROM events GROUP BY event_type",
    "dq_report": _DQ_REPORT,
    "upsert_latest": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1""",
    "run_health_summary": _HEALTH,
    "latest_failure": f"""
SELECT user_id, CAST(max(day) AS TIMESTAMP) AS last_failure_at,
       max(substring(props, 1, 120)) FILTER (WHERE rn_type = 1) AS last_error
FROM {_RUNS} WHERE event_type = 'error' GROUP BY user_id""",
    "key_conflicts": """
SELECT l_partkey, count(DISTINCT l_suppkey) AS n_owners, min(l_suppkey) AS first_owner
FROM lineitem WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL
GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1""",
    "duplicate_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "version_changes": f"""
WITH h AS (SELECT o_custkey, o_orderkey, o_orderdate, {_HASH} AS version_hash FROM {_VERSIONED}),
l AS (
  SELECT *, lag(version_hash) OVER w AS previous_hash, row_number() OVER w AS rn
  FROM h WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT o_custkey, o_orderkey, o_orderdate, version_hash, previous_hash
FROM l WHERE rn = 1 OR version_hash IS DISTINCT FROM previous_hash""",
    "failure_alerts": f"SELECT event_id, user_id, {_ALERT} AS message FROM events WHERE event_type = 'error'",
    "health_by_customer": f"""
SELECT c.c_custkey AS user_id, c.c_name,
       coalesce(e.total_runs, 0) AS total_runs, coalesce(e.failures, 0) AS failures,
       e.last_run_at, e.last_status, e.last_error
FROM customer c LEFT JOIN ({_HEALTH}) e ON c.c_custkey = e.user_id""",
    "track_versions": f"""
WITH last AS (
  SELECT o_custkey, version_hash AS last_hash FROM (
    SELECT o_custkey, {_HASH} AS version_hash,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM {_VERSIONED} WHERE o_orderdate < {_VERSION_CUT}) WHERE rn = 1),
inc AS (
  SELECT o_custkey, o_orderstatus, o_orderpriority, {_HASH} AS version_hash FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM {_VERSIONED} WHERE o_orderdate >= {_VERSION_CUT}) WHERE rn = 1)
SELECT inc.* FROM inc LEFT JOIN last ON inc.o_custkey = last.o_custkey
WHERE last_hash IS DISTINCT FROM version_hash""",
    "run_all_loads": _RUN_ALL,
    "csv_roundtrip": """
SELECT * REPLACE (CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority || chr(10) || 'said "urgent", then left'
                       WHEN o_orderkey % 5 > 2 THEN o_orderpriority END AS o_orderpriority) FROM orders""",
    "json_records": "SELECT * REPLACE (CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS c_mktsegment) FROM customer",
    "stream_split_backlog": "SELECT * FROM events",
    "stream_restart": "SELECT * FROM events",
    "stream_unique_key": "SELECT * FROM events",
    "derived_rows": _CLEAN_EVENTS,
    "derived_groups": """
SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n_events, count(DISTINCT event_type) AS n_types,
       max(value) AS top_value, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "late_rows_load": f"""
SELECT *, (SELECT count(*) FROM events WHERE event_id % 7 = 0 AND ts <= (
  SELECT max(ts) FROM events WHERE ts <= {_SPLIT} AND event_id % 7 <> 0)) AS rows_late FROM events""",
    "zone_map_loads": "SELECT *, CAST(0 AS INTEGER) AS files_left_to_open FROM events",
    "keyed_small_updates": """
SELECT c.* REPLACE (CASE WHEN c_custkey % 2 = 0 THEN 'EVEN' ELSE c_mktsegment END AS c_mktsegment),
       coalesce(l.o_orderstatus, 'NONE') AS last_order_status
FROM customer c LEFT JOIN (
  SELECT o_custkey, o_orderstatus FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders
  ) WHERE rn = 1
) l ON c.c_custkey = l.o_custkey
UNION ALL
SELECT c_custkey + 1000000, NULL, NULL, NULL, 'NEW', NULL FROM customer
UNION ALL
SELECT * REPLACE (c_custkey + 2000000 AS c_custkey), 'ABSENT' FROM customer""",
    "run_log_of_failures": """
SELECT pipeline_name, status, rows_loaded, error, TRUE AS has_run_id, TRUE AS rounded, TRUE AS in_utc, owner, status AS last_status,
       TRUE AS created_before, CASE WHEN status = 'SUCCESS' THEN '✓' ELSE '✗' END AS indicator
FROM (SELECT 'a_missing' AS pipeline_name, 'FAILED' AS status, CAST(0 AS BIGINT) AS rows_loaded, 'CSV source not found' AS error,
             'finance' AS owner
      UNION ALL
      SELECT 'b_keyless', 'FAILED', 0, 'incremental_key ''no_such_key'' not found in columns: ['
             || (SELECT string_agg(chr(39) || column_name || chr(39), ', ' ORDER BY column_index) FROM duckdb_columns() WHERE table_name = 'customer')
             || ']', 'finance'
      UNION ALL SELECT 'customer_feed', 'SUCCESS', (SELECT count(*) FROM customer), NULL, 'warehouse-team')""",
    "conflicting_loads": """
SELECT 'raw_orders' AS destination, CAST(2 AS BIGINT) AS n_owners, 'orders_feed' AS first_claimant, count(*) AS rows_loaded,
       FALSE AS loaded_before FROM orders""",
    "param_write": r"""
SELECT o_orderkey, 'it''s "fine"; DROP TABLE notes -- \' AS note FROM orders WHERE o_orderstatus = 'F'""",
    "latest_event": "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 1",
    "audited_events": f"SELECT *, TRUE AS stamped FROM ({_CLEAN_EVENTS})",
    "drift_blocked_load": """
SELECT 'SUCCESS' AS status, count(*) AS rows_extracted, count(*) AS rows_loaded, CAST(0 AS BIGINT) AS rows_without_key,
       CAST(NULL AS VARCHAR) AS error_message FROM orders
UNION ALL
SELECT 'FAILED', count(*), 0, 0, 'Schema drift detected:' FROM orders""",
    "forced_load": """
SELECT *, (SELECT count(*) FROM orders WHERE o_orderkey % 8 = 0) AS rows_without_key FROM (
  SELECT * FROM orders WHERE o_orderkey % 8 <> 0
  UNION ALL
  SELECT * REPLACE (o_orderkey + 10000000 AS o_orderkey, NULL AS o_orderpriority) FROM orders)""",
    "upsert_partial_columns": """
SELECT * REPLACE (CASE WHEN c_custkey % 2 = 0 THEN 'EVEN' ELSE c_mktsegment END AS c_mktsegment) FROM customer
UNION ALL
SELECT c_custkey + 1000000, NULL, NULL, NULL, 'NEW' FROM customer""",
    "append_twice": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "by_name_load": """
SELECT * FROM customer
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer""",
    "insert_if_absent": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders
) WHERE rn = 1""",
    "update_by_key": """
SELECT c.*, coalesce(l.o_orderstatus, 'NONE') AS last_order_status
FROM customer c LEFT JOIN (
  SELECT o_custkey, o_orderstatus FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders
  ) WHERE rn = 1
) l ON c.c_custkey = l.o_custkey""",
    "schema_report": f"SELECT column_name, t AS column_type, column_index AS ordinal FROM {_ORDERS_COLUMNS}",
    "schema_drift": f"""
SELECT 'o_custkey' AS column_name, 'type_changed' AS change, t AS stored_type, 'string' AS incoming_type
FROM {_ORDERS_COLUMNS} WHERE column_name = 'o_custkey'
UNION ALL
SELECT column_name, 'removed', t, NULL FROM {_ORDERS_COLUMNS} WHERE column_name = 'o_orderpriority'
UNION ALL
SELECT 'o_urgency', 'added', NULL, t FROM {_ORDERS_COLUMNS} WHERE column_name = 'o_orderpriority'""",
    "dq_min_rows": _min_rows("min_5", 5) + " UNION ALL " + _min_rows("min_10000", 10000),
    "param_lookup": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
WHERE o_custkey = 899 ORDER BY o_orderkey""",
    "sql_passthrough": """
WITH ranked AS (
  SELECT r.r_name, cu.c_custkey, cu.c_acctbal,
         row_number() OVER (PARTITION BY r.r_name ORDER BY cu.c_acctbal DESC, cu.c_custkey) AS rk
  FROM customer cu JOIN nation na ON cu.c_nationkey = na.n_nationkey
                   JOIN region r ON na.n_regionkey = r.r_regionkey)
SELECT r_name, CAST(rk AS BIGINT) AS rk, c_custkey, c_acctbal FROM ranked WHERE rk <= 3
UNION ALL
SELECT r_name, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE) FROM region""",
    "incremental_two_runs": _TWO_RUNS,
    "overwrite_twice": "SELECT * FROM customer",
    "sql_transform": _SEGMENT_YEARS,
    "lineitem_load": "SELECT * FROM lineitem",
    "load_partitions": "SELECT * FROM events",
    "stream_available_now": _TWO_RUNS,
    "end_to_end_load": _USER_DAYS,
}
