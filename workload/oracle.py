"""The same queries in ANSI SQL, written independently of the DataFrame code.

Rounded figures are computed here in whole cents, so that they are exact: half up on a positive fraction ``a / b`` is
``(2a + b) // 2b``.
"""

from __future__ import annotations

_SPLIT = "TIMESTAMP '2024-01-15 00:00:00'"
_EVENTS = "event_id, ts, user_id, event_type, value, props"

_MOMENT = "(SELECT ts FROM events WHERE event_id = (SELECT max(event_id) // 2 FROM events))"

_CENTS = "CAST(round(sum(value) * 100) AS BIGINT)"
_EXACT = "CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE)"


def _history(source: str, columns: str, key: str, moment: str, tie: str, tracked: tuple[str, ...]) -> str:
    """Versions by numbering the changes of the tracked columns and grouping by that number."""
    order = f"PARTITION BY {key} ORDER BY {moment}, {tie}"
    changed = " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER w" for c in tracked)
    payload = [c.strip() for c in columns.split(",") if c.strip() != key]
    last = ", ".join(f"arg_max({c}, ({moment}, {tie})) AS {c}" for c in payload)
    return f"""
    marked AS (
        SELECT {columns}, CASE WHEN row_number() OVER w = 1 OR {changed} THEN 1 ELSE 0 END AS opens
        FROM {source} WINDOW w AS ({order})
    ),
    numbered AS (
        SELECT *, sum(opens) OVER ({order} ROWS UNBOUNDED PRECEDING) AS version FROM marked
    ),
    versions AS (
        SELECT {key}, version, min({moment}) AS __START_AT, {last} FROM numbered GROUP BY {key}, version
    ),
    history AS (
        SELECT {columns}, __START_AT, lead(__START_AT) OVER (PARTITION BY {key} ORDER BY version) AS __END_AT
        FROM versions
    )
    """


_USER_HISTORY = _history("events", _EVENTS, "user_id", "ts", "event_id", ("event_type",))
_ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_ORDER_HISTORY = _history(
    "orders", _ORDER_COLUMNS, "o_custkey", "o_orderdate", "o_orderkey", ("o_orderstatus", "o_orderpriority")
)
_TYPE_HISTORY = _history("events", _EVENTS, "event_type", "ts", "event_id", ("user_id",))

_ALL_EVENTS = f"SELECT {_EVENTS} FROM events"
_USER_VERSIONS = f"WITH {_USER_HISTORY} SELECT * FROM history"
_VALID = "event_type IN ('view', 'click', 'purchase', 'signup') AND value > 0"

_CREATORS = """
    SELECT c_custkey AS artist_id, c_name AS artist_name, n_name AS genre, count(l_linenumber) AS total_streams,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_listen_duration_sec
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    GROUP BY c_custkey, c_name, n_name
"""
_PLACE = "row_number() OVER (ORDER BY total_streams DESC, artist_id) AS position"
_FIRST_TEN = "ORDER BY total_streams DESC, artist_id LIMIT 10"


def _one_per_user(order: str) -> str:
    return (
        f"SELECT {_EVENTS} FROM events "
        f"QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts {order}, event_id {order}) = 1"
    )


def _rule(name: str, predicate: str, action: str) -> str:
    return (
        f"SELECT 'events' AS table_name, '{name}' AS rule, '{action}' AS action, "
        f"count(*) FILTER (WHERE {predicate}) AS passed, "
        f"count(*) - count(*) FILTER (WHERE {predicate}) AS failed FROM events"
    )


_RULES = [
    _rule("valid_user_id", "user_id IS NOT NULL", "warn"),
    _rule("known_type", "event_type IN ('view', 'click', 'purchase', 'signup')", "drop"),
    _rule("positive_value", "value > 0", "drop"),
    _rule("large_value", "value >= 150", "warn"),
]


def _count(table: str) -> str:
    return f"SELECT '{table}' AS table_name, count(*) AS row_count FROM {table}"


def _audited(table: str, moment: str) -> str:
    """The audit row of a table; the mark is a timestamp as text, without trailing zeros of the fraction."""
    mark = f"rtrim(rtrim(strftime(max({moment}), '%Y-%m-%d %H:%M:%S.%f'), '0'), '.')"
    return (
        f"SELECT '{table}' AS table_name, 'OK' AS status, count({moment}) AS row_count, "
        f"count(*) - count({moment}) AS null_cdc_rows, {mark} AS watermark FROM {table}"
    )


# The published model's users and facts, and its tables after all rows have come.
_TIERED = """(
    SELECT CAST(user_id AS INTEGER) AS user_id, ' user ' || user_id AS raw_name, 'none' AS country,
           CASE event_type WHEN 'view' THEN 'Free' WHEN 'click' THEN 'Premium' WHEN 'purchase' THEN 'Family'
               WHEN 'signup' THEN 'Student' END AS subscription_type,
           CAST(ts AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date, ts AS updated_at,
           'USER ' || user_id AS user_name
    FROM events WHERE event_type IN ('view', 'click', 'purchase', 'signup')
)"""
_TIER_HISTORY = _history(
    _TIERED,
    "user_id, user_name, country, subscription_type, start_date, updated_at",
    "user_id",
    "updated_at",
    "updated_at",
    ("subscription_type", "country"),
)
_LISTENED = "(SELECT *, CAST(floor(value) AS BIGINT) AS seconds FROM events WHERE floor(value) > 0)"

ORACLE: dict[str, str] = {
    "incremental_extract": f"{_ALL_EVENTS} WHERE ts > {_MOMENT}",
    "backfill_extract": f"{_ALL_EVENTS} WHERE ts >= {_MOMENT}",
    "window_extract": """
        SELECT * FROM orders
        WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1997-12-31 00:00:00'
    """,
    "watermark_max": """
        SELECT 'events' AS table_name, max(ts) AS watermark FROM events
        UNION ALL SELECT 'orders', max(o_orderdate) FROM orders
        UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem
    """,
    "drop_columns": "SELECT * EXCLUDE (props) FROM events",
    "standardize_name": "SELECT c_custkey, upper(trim(c_name)) AS c_name FROM customer",
    "clean_title": "SELECT o_orderkey, trim(replace(o_orderpriority, '-', ' ')) AS o_orderpriority FROM orders",
    "duration_flag": """
        SELECT event_id, value,
               CASE WHEN value < 150 THEN 'low' WHEN value < 300 THEN 'medium' ELSE 'high' END AS duration_flag
        FROM events
    """,
    "event_date": "SELECT event_id, CAST(ts AS DATE) AS event_date FROM events",
    "in_list_filter": f"{_ALL_EVENTS} WHERE event_type IN ('view', 'purchase')",
    "not_null_filter": f"{_ALL_EVENTS} WHERE user_id IS NOT NULL AND event_type <> 'error'",
    "positive_filter": "SELECT * FROM customer WHERE c_acctbal > 0",
    "minutes_rounding": f"""
        SELECT user_id, ((2 * {_CENTS} + 60) // 120) / 100.0::DOUBLE AS total_minutes FROM events GROUP BY user_id
    """,
    "search_rows": """
        SELECT * FROM customer WHERE concat_ws(chr(10), *COLUMNS(*)) ILIKE '%build%'
    """,
    "preview": "SELECT *, row_number() OVER (ORDER BY o_orderkey) AS position FROM orders ORDER BY o_orderkey LIMIT 100",
    "union_batches": f"""
        SELECT event_id, ts, user_id, event_type, value, CASE WHEN ts < {_SPLIT} THEN props END AS props FROM events
    """,
    "inner_join_using": """
        SELECT l_orderkey, l_linenumber, l_extendedprice, o_custkey AS c_custkey, o_orderpriority
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
    "bucketed_bridge_join": """
        SELECT c_custkey, l_orderkey, l_linenumber, l_extendedprice, o_orderpriority, c_name, c_mktsegment
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    """,
    "bridge_join": """
        SELECT c_custkey, l_orderkey, l_linenumber, l_extendedprice, o_orderpriority, c_name, c_mktsegment
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    """,
    "star_join": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, o_orderstatus, o_orderdate, c_name,
               c_mktsegment, p_name, p_brand
        FROM lineitem
        LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN part ON l_partkey = p_partkey
    """,
    "join_current_version": """
        WITH newest AS (
            SELECT user_id, event_type AS current_type FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
        )
        SELECT e.event_id, e.user_id, e.event_type, n.current_type FROM events e JOIN newest n USING (user_id)
    """,
    "daily_metrics": f"""
        SELECT CAST(ts AS DATE) AS stream_date, count(event_id) AS total_streams, count(user_id) AS stream_events,
               {_EXACT} AS total_listen_seconds,
               CAST({_CENTS} AS DOUBLE) / (100 * count(value)) AS avg_listen_duration_seconds
        FROM events GROUP BY 1
    """,
    "daily_metrics_extended": f"""
        SELECT CAST(ts AS DATE) AS stream_date, count(event_id) AS total_streams, count(user_id) AS stream_events,
               count(DISTINCT user_id) AS unique_listeners, {_EXACT} AS total_listen_seconds,
               ((2 * {_CENTS} + 60) // 120) / 100.0::DOUBLE AS total_listen_minutes,
               ((2 * {_CENTS} + 10 * count(value)) // (20 * count(value))) / 10.0::DOUBLE
                   AS avg_listen_duration_seconds,
               row_number() OVER (ORDER BY CAST(ts AS DATE)) AS position
        FROM events GROUP BY CAST(ts AS DATE)
    """,
    "daily_kpis": f"""
        SELECT CAST(ts AS DATE) AS stream_date, count(event_id) AS total_streams, count(user_id) AS stream_events,
               ((2 * {_CENTS} + 60) // 120) / 100.0::DOUBLE AS total_minutes,
               ((2 * {_CENTS} + 10 * count(value)) // (20 * count(value))) / 10.0::DOUBLE AS avg_duration_sec,
               row_number() OVER (ORDER BY CAST(ts AS DATE) DESC) AS position
        FROM events GROUP BY CAST(ts AS DATE)
    """,
    "top_creators_all": _CREATORS,
    "top_creators": f"SELECT *, {_PLACE} FROM ({_CREATORS} {_FIRST_TEN})",
    "top_creators_minutes": f"""
        SELECT *, ((2 * CAST(round(total_listen_duration_sec * 100) AS BIGINT) + 60) // 120) / 100.0::DOUBLE
                   AS total_listen_minutes, {_PLACE}
        FROM ({_CREATORS} {_FIRST_TEN})
    """,
    "top_creators_ascending": f"""
        SELECT *, row_number() OVER (ORDER BY total_streams, artist_id) AS position FROM ({_CREATORS} {_FIRST_TEN})
    """,
    "top_suppliers": f"""
        SELECT s_suppkey AS artist_id, s_name AS artist_name, n_name AS genre, count(l_orderkey) AS total_streams,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_listen_duration_sec
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        GROUP BY s_suppkey, s_name, n_name {_FIRST_TEN}
    """,
    "tier_distribution": """
        WITH newest AS (
            SELECT user_id, event_type FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
        )
        SELECT n.event_type, count(e.event_id) AS total_streams, count(DISTINCT e.user_id) AS active_users
        FROM events e JOIN newest n USING (user_id) GROUP BY n.event_type
    """,
    "segment_distribution": """
        SELECT c_mktsegment, count(o_orderkey) AS total_streams, count(DISTINCT c_custkey) AS active_users
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
    """,
    "value_counts_type": """
        SELECT event_type, count(*) AS row_count FROM events WHERE event_type IS NOT NULL GROUP BY event_type
    """,
    "value_counts_brand": """
        SELECT p_brand, count(*) AS row_count FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand
    """,
    "current_tier_counts": f"""
        SELECT event_type, count(*) AS row_count FROM ({_one_per_user("DESC")}) GROUP BY event_type
    """,
    "table_counts": " UNION ALL ".join(
        _count(t) for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    ),
    "dedupe_any": "SELECT DISTINCT user_id FROM events",
    "dedupe_first": _one_per_user("ASC"),
    "dedupe_latest": _one_per_user("DESC"),
    "dedupe_version": f"SELECT DISTINCT {_EVENTS} FROM events",
    "expect_report": " UNION ALL ".join(_RULES),
    "expect_or_drop": f"{_ALL_EVENTS} WHERE {_VALID}",
    "expect_observed": f"{_ALL_EVENTS} WHERE {_VALID}",
    "fact_table": f"SELECT {_EVENTS}, CAST(ts AS DATE) AS stream_date FROM events WHERE {_VALID}",
    "scd1_latest": """
        SELECT * FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """,
    "scd2_history": _USER_VERSIONS,
    "scd2_out_of_order": _USER_VERSIONS,
    "scd2_two_columns": f"WITH {_ORDER_HISTORY} SELECT * FROM history",
    "scd2_few_keys": f"WITH {_TYPE_HISTORY} SELECT * FROM history",
    "scd2_current": f"""
        WITH {_USER_HISTORY}
        SELECT {_EVENTS}, __START_AT, TRUE AS __IS_CURRENT FROM history WHERE __END_AT IS NULL
    """,
    "scd2_closed_intervals": f"""
        WITH {_USER_HISTORY}
        SELECT {_EVENTS}, __END_AT IS NULL AS is_current, __START_AT AS valid_from,
               coalesce(__END_AT, TIMESTAMP '9999-12-31 23:59:59') AS valid_to
        FROM history
    """,
    "history_preview": f"""
        WITH {_USER_HISTORY}
        SELECT *, row_number() OVER (ORDER BY user_id, __START_AT, event_id) AS position FROM history
        ORDER BY position LIMIT 20
    """,
    "stream_to_silver": _ALL_EVENTS,
    "stream_quality": f"{_ALL_EVENTS} WHERE {_VALID}",
    "stream_dedupe_first": "SELECT DISTINCT user_id FROM events",
    "stream_facts": _ALL_EVENTS,
    "stream_scd2": _USER_VERSIONS,
    "store_replay": _USER_VERSIONS,
    "stream_rule_totals": " UNION ALL ".join(_RULES),
    "schema_evolve": f"""
        SELECT event_id, ts, user_id, event_type, value, CASE WHEN ts >= {_SPLIT} THEN props END AS props,
               CAST(NULL AS VARCHAR) AS _rescued_data
        FROM events
    """,
    "rescue_malformed": """
        SELECT event_id, user_id, TRY_CAST(props AS INTEGER) AS props,
               '{"props":' || CAST(to_json(props) AS VARCHAR) || ',"ts":"' || ts || '","event_type":'
                   || CAST(to_json(event_type) AS VARCHAR) || ',"value":"' || value || '"}' AS _rescued_data
        FROM events
    """,
    "rescue_twice": """
        SELECT event_id,
               '{"props":' || CAST(to_json(props) AS VARCHAR) || ',"ts":"' || ts || '","event_type":'
                   || CAST(to_json(event_type) AS VARCHAR) || ',"value":"' || value || '","user_id":"' || user_id || '"}' AS _rescued_data
        FROM events
    """,
    "bronze_round_trip": "SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM orders",
    "table_round_trip": "SELECT * FROM part",
    "table_metadata": """
        SELECT 'comment' AS fact, 'Parts' AS value UNION ALL SELECT 'declared rows', '0' UNION ALL
        SELECT 'quality', 'gold' UNION ALL SELECT 'rows', CAST(count(*) AS VARCHAR) FROM part
    """,
    "control_cycle": " UNION ALL ".join(
        f"SELECT {run} AS run, table_name, {status} AS status, {rows} AS row_count, watermark FROM ({_audited(table, moment)})"
        for run, status, rows in ((1, "status", "row_count"), (2, "'EMPTY'", "0"))
        for table, moment in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
    ),
    "watermark_ties": "SELECT * FROM orders",
    "ingest_audit": f"""
        {_audited("events", "ts")} UNION ALL {_audited("orders", "o_orderdate")} UNION ALL
        {_audited("lineitem", "l_shipdate")} UNION ALL
        SELECT 'returns', 'FAILED', 0, 0, NULL
    """,
    "ingest_cycle": _ALL_EVENTS,
    "full_cycle": """
        WITH users AS (
            SELECT user_id, ts, CASE event_type WHEN 'view' THEN 'Free' WHEN 'click' THEN 'Premium'
                       WHEN 'purchase' THEN 'Family' WHEN 'signup' THEN 'Student' END AS tier
            FROM events
        ),
        now AS (
            SELECT user_id, tier FROM users WHERE tier IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1
        ),
        tracks AS (SELECT * FROM part WHERE p_size > 0)
        SELECT e.event_id AS stream_id, CAST(floor(e.value) AS INTEGER) AS listen_duration,
               e.event_type AS device_type, e.ts AS stream_timestamp,
               CAST(n.user_id AS INTEGER) AS user_id, 'USER ' || n.user_id AS user_name,
               CASE WHEN n.user_id IS NOT NULL THEN 'none' END AS country, n.tier AS subscription_type,
               CAST(t.p_partkey AS INTEGER) AS track_id, t.p_name AS track_name, t.p_brand AS album_name,
               t.p_size * 10 AS duration_sec,
               CASE WHEN t.p_partkey IS NULL THEN NULL WHEN t.p_size < 15 THEN 'low' WHEN t.p_size < 30 THEN 'medium'
                    ELSE 'high' END AS "durationFlag",
               CAST(s.s_suppkey AS INTEGER) AS artist_id, s.s_name AS artist_name,
               CASE WHEN s.s_suppkey IS NOT NULL THEN 'Pop' END AS genre
        FROM events e
        LEFT JOIN now n ON e.user_id = n.user_id
        LEFT JOIN tracks t ON e.user_id = t.p_partkey
        LEFT JOIN supplier s ON t.p_size = s.s_suppkey
        WHERE floor(e.value) > 0
    """,
    "cycle_user_history": f"WITH {_TIER_HISTORY} SELECT *, CAST(NULL AS DATE) AS end_date FROM history",
    "cycle_dates": """
        SELECT DISTINCT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, CAST(ts AS DATE) AS date,
               CAST(day(ts) AS INTEGER) AS day, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year,
               dayname(ts) AS weekday
        FROM events
    """,
    "cycle_daily": f"""
        SELECT CAST(ts AS DATE) AS stream_date, count(event_id) AS total_streams, count(user_id) AS stream_events,
               count(DISTINCT user_id) AS unique_listeners, CAST(sum(seconds) AS BIGINT) AS total_listen_seconds,
               CAST((200 * sum(seconds) + 60) // 120 AS BIGINT) / 100.0::DOUBLE AS total_listen_minutes,
               CAST((20 * sum(seconds) + count(seconds)) // (2 * count(seconds)) AS BIGINT) / 10.0::DOUBLE
                   AS avg_listen_duration_seconds
        FROM {_LISTENED} GROUP BY 1
    """,
    "cycle_top": f"""
        SELECT CAST(s_suppkey AS INTEGER) AS artist_id, s_name AS artist_name, 'Pop' AS genre,
               count(event_id) AS total_streams, CAST(sum(seconds) AS BIGINT) AS total_listen_duration_sec
        FROM {_LISTENED} e JOIN part ON e.user_id = p_partkey JOIN supplier ON p_size = s_suppkey
        WHERE p_size > 0 GROUP BY 1, 2, 3
    """,
}
