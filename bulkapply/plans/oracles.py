"""For each registered query the SQL that gives the same rows, for a check by another engine."""

from __future__ import annotations

_LINE_REST = (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    "l_shipdate",
)


def _desc(*columns: str) -> str:
    return ", ".join(f"{c} DESC" for c in columns)


_EVENT_OP = (
    "CASE WHEN event_type = 'signup' THEN '+I' WHEN event_type IN ('purchase', 'click') THEN '+U' "
    "WHEN event_type = 'view' THEN '-U' WHEN event_type = 'error' THEN '-D' END"
)
_LINE_OP = (
    "CASE WHEN l_returnflag = 'N' THEN '+I' WHEN l_returnflag = 'A' THEN '+U' "
    "WHEN l_linestatus = 'F' THEN '-D' ELSE '-U' END"
)
_EVENTS = f"(SELECT *, {_EVENT_OP} AS _op FROM events)"
_LINES = f"(SELECT *, {_LINE_OP} AS _op FROM lineitem)"
_UP = "(_op IN ('+I', '+U'))"
_FLUSHED = (
    "(SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 1000 AS flush_id FROM events)"
)
_LAST_LINE = (
    f"SELECT * FROM {_LINES} QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    f"ORDER BY l_shipdate DESC, {_UP} DESC, {_desc(*_LINE_REST)}, _op DESC) = 1"
)
_LINE_STATE = f"SELECT * EXCLUDE (_op) FROM ({_LAST_LINE}) WHERE {_UP}"
_LAST_EVENT = (
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
)
_UPSERTED_LINES = (
    "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    f"ORDER BY l_linestatus DESC, l_shipdate DESC, {_desc(*_LINE_REST)}) = 1"
)
_TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def _text(column: str) -> str:
    return f"""coalesce('"' || replace({column}, '"', '""') || '"', '')"""


def _plain(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), '')"


def _moment(column: str, form: str) -> str:
    return f"coalesce(strftime({column}, '{form}'), '')"


def _line(*fields: str) -> str:
    return " || ',' || ".join(fields) + " AS line"


_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, column_name, n, (SELECT count(*) FROM {t}) AS row_count FROM "
    f"(UNPIVOT (SELECT count(COLUMNS(*)) FROM {t}) ON COLUMNS(*) INTO NAME column_name VALUE n)"
    for t in _TABLE_NAMES
)
_SCHEMA_REPORT = f"""
WITH counted AS ({_COUNTS}),
typed AS (
  SELECT table_name, column_name, data_type AS duck_type FROM information_schema.columns
  WHERE table_name IN ({', '.join(f"'{t}'" for t in _TABLE_NAMES)})
)
SELECT table_name, row_count, column_name,
  CASE duck_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
    WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
    ELSE duck_type END AS data_type,
  duck_type NOT LIKE '%[]' AS supported,
  CASE WHEN duck_type LIKE '%[]' THEN 'none' ELSE duck_type END AS sql_type,
  row_count - n AS null_count
FROM counted JOIN typed USING (table_name, column_name)
"""

_ORDERS_BOUND = (
    "SELECT o_orderkey AS id, 'C' || o_custkey AS buyer, CAST(o_totalprice AS DECIMAL(12,2)) AS amount, "
    "CAST(o_orderdate AS DATE) AS ordered_on FROM orders"
)
_LINES_OF_EVERY_TYPE = (
    "SELECT l_orderkey, l_linenumber, l_linestatus = 'O' AS flag, CAST(l_linenumber AS TINYINT) AS line_number, "
    "CAST(l_quantity AS SMALLINT) AS quantity, CAST(floor(l_tax * 100) / 2 AS FLOAT) AS tax, "
    "CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_shipdate AS DATE) AS shipped, "
    "'\\x' || lower(hex(l_returnflag || l_linestatus)) AS code FROM lineitem"
)


def oracle_sql() -> dict[str, str]:
    sql = {
        "append_orders": "SELECT * FROM orders",
        "append_twice": "SELECT * FROM orders UNION ALL "
        "SELECT * REPLACE (o_orderkey + 100000000000 AS o_orderkey) FROM orders",
        "append_parallel": "SELECT * FROM lineitem",
        "partitioned_append": "SELECT * FROM orders",
        "batch_agg_sink": "SELECT l_partkey AS product, count(*) AS sales_count FROM lineitem GROUP BY l_partkey",
        "append_keyed_writers": "SELECT l_suppkey, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_writers FROM lineitem GROUP BY l_suppkey",
        "append_unique": "SELECT * FROM orders",
        "insert_settled": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
        "upsert_last_wins": _LAST_EVENT,
        "upsert_lineitem": _UPSERTED_LINES,
        "upsert_keyed_layout": _UPSERTED_LINES,
        "upsert_settled": _UPSERTED_LINES,
        "upsert_other_key_type": _UPSERTED_LINES,
        "insert_if_absent": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
        "delete_by_key": "SELECT * FROM customer WHERE NOT EXISTS "
        "(SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')",
        "delete_other_key_type": "SELECT * FROM customer WHERE NOT EXISTS "
        "(SELECT 1 FROM orders WHERE o_custkey % 4 = 0 AND o_custkey // 4 = c_custkey)",
        "key_projection": "SELECT l_orderkey, l_linenumber FROM lineitem",
        "update_by_key": "SELECT o.o_orderkey, o.o_custkey, coalesce(r.l_linestatus, o.o_orderstatus) AS o_orderstatus, "
        "o.o_totalprice, o.o_orderdate, "
        "coalesce('RETURNED-' || r.l_linenumber, o.o_orderpriority) AS o_orderpriority "
        "FROM orders o LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R' "
        "QUALIFY row_number() OVER (PARTITION BY l_orderkey "
        "ORDER BY l_shipdate DESC, l_linestatus DESC, l_linenumber DESC) = 1) r ON r.l_orderkey = o.o_orderkey",
        "lookup_by_key": "SELECT c_custkey, c_name, c_nationkey FROM customer "
        "WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)",
        "row_exists": "SELECT c_custkey, c_name, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS has_order "
        "FROM customer",
        "limit_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100",
        "limit_rows_ties": "SELECT * FROM orders ORDER BY o_orderstatus, o_orderkey LIMIT 100",
        "rowkind_flag": f"SELECT event_id, _op, {_UP} AS is_upsert FROM {_EVENTS}",
        "changelog_collapse": f"SELECT * FROM {_EVENTS} QUALIFY row_number() OVER "
        "(PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
        "changelog_collapse_lines": _LAST_LINE,
        "changelog_apply": _LINE_STATE,
        "changelog_apply_settled": _LINE_STATE,
        "changelog_apply_touched": _LINE_STATE,
        "changelog_agg_upsert": "SELECT l_suppkey, count(*) AS n_rows, sum(CAST(l_quantity AS DECIMAL(12,2))) AS sum_quantity, "
        "min(l_shipdate) AS min_l_shipdate, max(l_extendedprice) AS max_l_extendedprice "
        f"FROM ({_LINE_STATE}) GROUP BY l_suppkey",
        "changelog_violations": "SELECT count(*) AS n_rows, "
        "count(*) FILTER (WHERE event_type = 'error') AS unknown_kind, "
        "count(*) FILTER (WHERE event_type = 'signup') AS null_key FROM events",
        "flush_batches": f"SELECT event_type, flush_id, count(*) AS n_rows, min(event_id) AS first_event, "
        f"max(ts) AS last_ts FROM {_FLUSHED} GROUP BY event_type, flush_id",
        "distinct_keys_per_flush": f"SELECT DISTINCT event_type, flush_id, user_id AS user_key FROM {_FLUSHED}",
        "changelog_collapse_per_flush": f"SELECT *, {_EVENT_OP} AS _op FROM {_FLUSHED} QUALIFY row_number() OVER "
        "(PARTITION BY event_type, flush_id, user_id ORDER BY ts DESC, event_id DESC) = 1",
        "flush_windows": "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS flush_start, count(*) AS n_rows FROM events GROUP BY 1",
        "flush_windows_per_writer": "SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS flush_start, count(*) AS n_rows "
        "FROM events GROUP BY 1, 2",
        "stream_custom_dml": "SELECT o_orderkey AS id, lower(o_orderstatus) AS status FROM orders",
        "custom_dml_bind": _ORDERS_BOUND,
        "custom_dml_sql": "SELECT id, upper(buyer) AS buyer, CAST(amount * 2 AS DECIMAL(13,2)) AS doubled, ordered_on "
        f"FROM ({_ORDERS_BOUND})",
        "copy_encode_docs": "SELECT doc_id, "
        + _line(_plain("doc_id"), _text("text"), _text("lang"), _text("source"), _plain("n_chars"))
        + " FROM documents",
        "copy_encode_pages": "SELECT page_id, " + _line(_plain("page_id"), _text("url"), _text("html")) + " FROM pages",
        "copy_encode_lineitem": "SELECT "
        + _line(
            *[_plain(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
            *[_plain(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
            _text("l_returnflag"), _text("l_linestatus"), _moment("l_shipdate", "%Y-%m-%d %H:%M:%S.%g"),
        )
        + " FROM lineitem",
        "copy_encode_events": "SELECT event_id, "
        + _line(
            _plain("event_id"), _moment("ts", "%Y-%m-%d %H:%M:%S.%f"), _plain("user_id"), _text("event_type"),
            _plain('"value"'), _text("props"),
        )
        + " FROM events",
        "copy_encode_nulls": "SELECT "
        + _line(
            _plain("c_custkey"), _text("c_name"), _plain("o_orderkey"), _text("o_orderstatus"), _plain("o_totalprice"),
            _moment("o_orderdate", "%Y-%m-%d %H:%M:%S"),
        )
        + " FROM customer LEFT JOIN orders ON c_custkey = o_custkey",
        "copy_roundtrip": "SELECT * FROM documents",
        "copy_encode_types": "SELECT l_orderkey, l_linenumber, "
        + _line(*[_plain(c) for c in ("flag", "line_number", "quantity", "tax", "price", "shipped", "code")])
        + f" FROM ({_LINES_OF_EVERY_TYPE})",
        "copy_roundtrip_types": f"SELECT * REPLACE (substr(code, 3) AS code) FROM ({_LINES_OF_EVERY_TYPE})",
        "convert_types": "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS DECIMAL(18,0)) AS o_custkey, "
        "CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, "
        "o_orderpriority FROM orders",
        "schema_report": _SCHEMA_REPORT,
        "schema_conformance": "SELECT count(*) AS n_rows, "
        "count(*) FILTER (WHERE TRY_CAST(o_orderkey AS SMALLINT) IS NULL) AS o_orderkey_misfits, "
        "count(*) FILTER (WHERE TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NULL) AS o_totalprice_misfits, "
        "count(*) FILTER (WHERE length(o_orderpriority) > 8) AS o_orderpriority_misfits, "
        "count(*) FILTER (WHERE TRY_CAST(o_orderdate AS TIMESTAMP) IS NULL) AS o_orderdate_misfits FROM orders",
        "stream_append": "SELECT * FROM events",
        "stream_copy_files": "SELECT * FROM documents",
        "stream_upsert": _LAST_EVENT,
        "stream_changelog": _LINE_STATE,
        "stream_compacted": _LINE_STATE,
        "stream_replay": _LINE_STATE,
        "stream_agg_upsert": "SELECT event_type, count(*) AS n_events, max(ts) AS last_ts FROM events GROUP BY event_type",
        "split_read_range": "SELECT orders.*, CAST((o_orderkey - lo) // ((hi - lo + 4) // 4) AS INTEGER) AS split "
        "FROM orders, (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders)",
        "split_read_balanced": "SELECT * FROM lineitem",
        "split_read_values": "SELECT *, CAST(o_orderpriority[1] AS INTEGER) - 1 AS split FROM orders",
    }
    return sql | {"update_settled": sql["update_by_key"]}
