"""Reference SQL for each registered query, written directly against the
source tables (ANSI SQL as DuckDB runs it).

Each statement computes from the raw tables what the Spark query publishes
and reads back, so a match checks the whole path: landing text, casts,
quality gate, writers and readers.
"""

from __future__ import annotations

from terrace import queries as QS

_ORDER_DATE_PARTS = (
    "CAST(year(o_orderdate) AS INTEGER) AS year, "
    "CAST(month(o_orderdate) AS INTEGER) AS month, "
    "CAST(day(o_orderdate) AS INTEGER) AS day"
)

_TS_PARTS = "CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day"

_SILVER = rf"""
SELECT CAST(o_orderkey AS BIGINT) AS order_key,
       CAST(o_custkey AS BIGINT) AS customer_key,
       TRIM(LOWER(o_orderstatus)) AS order_status,
       COALESCE(TRIM(LOWER(o_orderstatus)) IN ('f', 'true'), FALSE) AS is_finished,
       CAST(o_totalprice AS DECIMAL(12, 2)) AS total_price,
       CAST(o_orderdate AS DATE) AS order_date,
       TRY_CAST(regexp_extract(TRIM(o_orderpriority), '^(\d+)', 1) AS INTEGER) AS priority_rank,
       TRIM(LOWER(o_orderpriority)) AS order_priority,
       '{QS.ORDERS_FILE}' AS source_file,
       '{QS.RUN_ID}' AS run_id,
       TIMESTAMP '{QS.PROCESSED_AT}' AS processed_at_utc
FROM orders
"""


def _gold(business_date: str, run_id: str) -> str:
    year, month, day = (int(p) for p in business_date.split("-"))
    return f"""
SELECT order_key,
       DATE '{business_date}' AS ingestion_date,
       CAST({year} AS INTEGER) AS year,
       CAST({month} AS INTEGER) AS month,
       CAST({day} AS INTEGER) AS day,
       customer_key, order_status, is_finished, total_price, order_date,
       priority_rank AS priority_score,
       CASE priority_rank WHEN 1 THEN 'urgent' WHEN 2 THEN 'high' WHEN 3 THEN 'medium'
                          WHEN 4 THEN 'not_specified' WHEN 5 THEN 'low' END AS priority_label,
       source_file,
       '{run_id}' AS run_id,
       TIMESTAMP '{QS.PROCESSED_AT}' AS processed_at_utc
FROM ({_SILVER}) silver
"""


def _gold_history() -> str:
    return f"""
SELECT order_key,
       order_date AS ingestion_date,
       CAST(year(order_date) AS INTEGER) AS year,
       CAST(month(order_date) AS INTEGER) AS month,
       CAST(day(order_date) AS INTEGER) AS day
FROM ({_SILVER}) silver
"""


def _union(*parts: str) -> str:
    return "\nUNION ALL\n".join(f"SELECT * FROM ({p}) u{i}" for i, p in enumerate(parts))


def _count_rule(rule: str, column: str, predicate: str, table: str, order: int | None = None) -> str:
    head = f"CAST({order} AS INTEGER) AS rule_order, " if order is not None else ""
    return f"SELECT {head}'{rule}' AS rule, '{column}' AS column_name, COUNT(*) FILTER (WHERE {predicate}) AS violations FROM {table}"


def _in_list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


_EVENTS_NULL_PREDICATES = [
    ("event_id", "event_id IS NULL"),
    ("user_id", "user_id IS NULL"),
    ("event_type", "NULLIF(event_type, 'error') IS NULL"),
    ("value", "value IS NULL"),
    ("props", "props IS NULL"),
    ("ingestion_date", "ts IS NULL"),
    ("year", "ts IS NULL"),
    ("month", "ts IS NULL"),
    ("day", "ts IS NULL"),
]

_LINEITEM_DUPLICATES = """
SELECT COUNT(*) AS violations FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
  GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
) duplicated
"""

_RANGE_RULES = [
    (4, "l_linenumber", "l_linenumber IS NOT NULL AND (l_linenumber < 1 OR l_linenumber > 6)"),
    (6, "l_quantity", "l_quantity IS NOT NULL AND (l_quantity < 5 OR l_quantity > 45)"),
    (8, "l_tax", "l_tax IS NOT NULL AND l_tax > 0.05"),
]

_DOMAIN_RULES = [
    (10, "l_returnflag", "l_returnflag IS NOT NULL AND CAST(l_returnflag AS VARCHAR) NOT IN ('A', 'N', 'R')"),
    (12, "l_linestatus", "l_linestatus IS NOT NULL AND CAST(l_linestatus AS VARCHAR) NOT IN ('F')"),
]

_NON_NULL_RULES = [
    (2, "l_orderkey"),
    (3, "l_linenumber"),
    (5, "l_quantity"),
    (7, "l_tax"),
    (9, "l_returnflag"),
    (11, "l_linestatus"),
    (13, "l_shipdate"),
]


def _quality_report() -> str:
    parts = [
        "SELECT CAST(0 AS INTEGER) AS rule_order, 'rows' AS rule, '*' AS column_name, COUNT(*) AS violations FROM lineitem",
        "SELECT CAST(-1 AS INTEGER) AS rule_order, 'columns' AS rule, '*' AS column_name, CAST(0 AS BIGINT) AS violations",
        f"SELECT CAST(1 AS INTEGER) AS rule_order, 'primary_key' AS rule, 'l_orderkey,l_linenumber' AS column_name, violations FROM ({_LINEITEM_DUPLICATES}) d",
    ]
    parts += [_count_rule("non_null", c, f"{c} IS NULL", "lineitem", order) for order, c in _NON_NULL_RULES]
    parts += [_count_rule("range", c, p, "lineitem", order) for order, c, p in _RANGE_RULES]
    parts += [_count_rule("domain", c, p, "lineitem", order) for order, c, p in _DOMAIN_RULES]
    return _union(*parts)


ORACLES: dict[str, str] = {
    "csv_bronze_scan": """
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, TRIM(LOWER(c_name)) AS c_name,
       CAST(c_nationkey AS INTEGER) AS c_nationkey, CAST(c_acctbal AS DECIMAL(12, 2)) AS c_acctbal,
       TRIM(LOWER(c_mktsegment)) AS c_mktsegment
FROM customer""",
    "landing_file_scan": "SELECT CAST(c_custkey AS BIGINT) AS key, c_name AS name, 'customer' AS source_stem FROM customer",
    "parquet_scan": "SELECT * FROM part",
    "partition_scan": f"SELECT *, {_ORDER_DATE_PARTS} FROM orders",
    "partition_prune_filter": f"SELECT *, {_ORDER_DATE_PARTS} FROM orders "
    f"WHERE CAST(o_orderdate AS DATE) = DATE '{QS.PRUNE_DATE[0]:04d}-{QS.PRUNE_DATE[1]:02d}-{QS.PRUNE_DATE[2]:02d}'",
    "sql_parameterized": f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice * (1 - l_discount) AS net_price,
       l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' AS shipped_after_cutoff,
       '{QS.RUN_ID}' AS run_id, DATE '{QS.BUSINESS_DATE}' AS business_date
FROM lineitem""",
    "parquet_full_overwrite": "SELECT c_custkey, UPPER(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "partition_full_overwrite": "SELECT *, CAST(2026 AS INTEGER) AS year, CAST(4 AS INTEGER) AS month, CAST(3 AS INTEGER) AS day FROM orders",
    "partition_overwrite_day": _union(
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, "
        "CAST(2026 AS INTEGER) AS year, CAST(4 AS INTEGER) AS month, CAST(2 AS INTEGER) AS day FROM orders",
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority, "
        "CAST(2026 AS INTEGER) AS year, CAST(4 AS INTEGER) AS month, CAST(3 AS INTEGER) AS day FROM orders",
    ),
    "snapshot_csv_single_file": _gold(QS.BUSINESS_DATE, QS.RUN_ID),
    "snapshot_parquet_single_file": _gold(QS.BUSINESS_DATE, QS.RUN_ID),
    "csv_dataset_sink": "SELECT * FROM customer",
    "sink_readback_count": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       COUNT(*) AS rows_written, COUNT(*) AS rows_read
FROM orders GROUP BY 1, 2""",
    "numeric_partition_layout": f"SELECT *, {_TS_PARTS} FROM events",
    "silver_normalize": _SILVER,
    "gold_enrich": _gold(QS.BUSINESS_DATE, QS.RUN_ID),
    "bi_snapshot": _gold(QS.BUSINESS_DATE, QS.RUN_ID),
    "medallion_chain": _union(_gold(QS.PREVIOUS_DATE, QS.PREVIOUS_RUN_ID), _gold(QS.BUSINESS_DATE, QS.RUN_ID)),
    "backfill_business_date": _union(_gold(QS.PREVIOUS_DATE, QS.BACKFILL_RUN_ID), _gold(QS.BUSINESS_DATE, QS.RUN_ID)),
    "run_summary": f"""
SELECT 'orders_gold_history' AS pipeline, '{QS.RUN_ID}' AS run_id, year, month, day, COUNT(*) AS rows_written
FROM ({_gold_history()}) g GROUP BY year, month, day""",
    "chain_audit": f"""
SELECT 'orders_a_gold' AS pipeline, '{QS.RUN_ID}' AS run_id, CAST(2026 AS INTEGER) AS year, CAST(4 AS INTEGER) AS month,
       CAST(2 AS INTEGER) AS day, COUNT(*) AS rows_written FROM orders
UNION ALL
SELECT 'orders_b_gold', '{QS.RUN_ID}', 2026, 4, 3, COUNT(*) FROM orders""",
    "chain_catalog_count": f"""
SELECT '{QS.PREVIOUS_DATE}' AS business_date, COUNT(*) AS row_count FROM orders
UNION ALL SELECT '{QS.BUSINESS_DATE}', 2 * COUNT(*) FROM orders""",
    "csv_by_header_name": """
SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(12, 2)) AS c_acctbal,
       CASE WHEN c_custkey % 2 = 0 THEN 'a' ELSE 'b' END AS stem
FROM customer""",
    "catalog_numeric_publish": _union(_gold(QS.PREVIOUS_DATE, QS.PREVIOUS_RUN_ID), _gold(QS.BUSINESS_DATE, QS.RUN_ID)),
    "catalog_synced_partitions": "SELECT 'year=2026/month=4/day=3' AS partition, COUNT(*) AS row_count FROM orders",
    "stream_explicit_run": f"""
SELECT o_orderkey AS order_key, 'orders-00000.csv' AS source_file, '{QS.BACKFILL_RUN_ID}' AS run_id,
       DATE '{QS.PREVIOUS_DATE}' AS ingestion_date, CAST(2026 AS INTEGER) AS year, CAST(4 AS INTEGER) AS month,
       CAST(2 AS INTEGER) AS day, COUNT(*) OVER () AS rows_written
FROM orders""",
    "silver_normalize_sql": _SILVER,
    "silver_gate_observed": _SILVER,
    "gold_gate_observed": _union(_gold(QS.PREVIOUS_DATE, QS.PREVIOUS_RUN_ID), _gold(QS.BUSINESS_DATE, QS.RUN_ID)),
    "gold_numeric_publish": _union(_gold(QS.PREVIOUS_DATE, QS.PREVIOUS_RUN_ID), _gold(QS.BUSINESS_DATE, QS.RUN_ID)),
    "catalog_registered_publish": _union(_gold(QS.PREVIOUS_DATE, QS.PREVIOUS_RUN_ID), _gold(QS.BUSINESS_DATE, QS.RUN_ID)),
    "cast_integer": """
SELECT l_orderkey, l_linenumber, l_linenumber AS padded_linenumber, TRY_CAST(l_returnflag AS INTEGER) AS returnflag_as_int
FROM lineitem""",
    "cast_decimal": """
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(12, 2)) AS extended_price,
       CAST(l_tax AS DECIMAL(12, 2)) AS tax, TRY_CAST(l_returnflag AS DECIMAL(12, 2)) AS returnflag_as_decimal
FROM lineitem""",
    "flag_yes_no": """
SELECT o_orderkey, o_orderstatus,
       COALESCE(TRIM(LOWER(o_orderstatus)) IN ('f', 'true'), FALSE) AS is_finished,
       COALESCE(TRIM(LOWER(o_orderstatus)) IN ('yes', 'true'), FALSE) AS is_yes,
       COALESCE(TRIM(LOWER(NULLIF(o_orderstatus, 'P'))) IN ('p'), FALSE) AS null_is_false
FROM orders""",
    "score_label": """
SELECT l_orderkey, l_linenumber,
       CASE l_linenumber WHEN 1 THEN 'low' WHEN 2 THEN 'medium' WHEN 3 THEN 'high' WHEN 4 THEN 'very_high' END AS linenumber_label
FROM lineitem""",
    "lineage_columns": f"""
SELECT o_orderkey, '{QS.ORDERS_FILE}' AS source_file, '{QS.RUN_ID}' AS run_id,
       TIMESTAMP '{QS.PROCESSED_AT}' AS processed_at_utc
FROM orders""",
    "business_date_columns": f"SELECT event_id, CAST(ts AS DATE) AS ingestion_date, {_TS_PARTS} FROM events",
    "iso_date_parse": f"""
SELECT event_id, CAST(ts AS DATE) AS date_from_t, CAST(ts AS DATE) AS date_from_space, CAST(ts AS DATE) AS date_only,
       CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) ELSE DATE '{QS.BUSINESS_DATE}' END AS empty_is_run_date
FROM events""",
    "path_file_name": r"SELECT page_id, regexp_extract(regexp_replace(url, '/+$', ''), '([^/]*)$', 1) AS file_name FROM pages",
    "quality_pk_duplicates": _LINEITEM_DUPLICATES,
    "quality_non_null": _union(*[_count_rule("non_null", c, p, "events") for c, p in _EVENTS_NULL_PREDICATES]),
    "quality_domain": _union(
        _count_rule("domain", "p_brand", f"p_brand IS NOT NULL AND CAST(p_brand AS VARCHAR) NOT IN ({_in_list(QS.PART_BRAND_DOMAIN)})", "part"),
        _count_rule("domain", "p_size", f"p_size IS NOT NULL AND CAST(p_size AS VARCHAR) NOT IN ({_in_list(QS.PART_SIZE_DOMAIN)})", "part"),
    ),
    "quality_range": _union(*[_count_rule("range", c, p, "lineitem") for _, c, p in _RANGE_RULES]),
    "quality_ingestion_date": _count_rule(
        "ingestion_date", "ingestion_date", f"CAST(ts AS DATE) <> DATE '{QS.EVENTS_RUN_DATE}'", "events"
    ),
    "quality_partition_coherence": _union(
        _count_rule("partition", "year", "year(ts) <> 2024", "events"),
        _count_rule("partition", "month", "month(ts) <> 1", "events"),
        _count_rule("partition", "day", "day(ts) <> 15", "events"),
    ),
    "quality_report": _quality_report(),
    "catalog_external_table": _SILVER,
    "catalog_partitioned_table": _union(_gold(QS.PREVIOUS_DATE, QS.PREVIOUS_RUN_ID), _gold(QS.BUSINESS_DATE, QS.RUN_ID)),
    "catalog_row_count": "SELECT COUNT(*) * 3 AS row_count FROM orders",
    "stream_landing_ingest": "SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS event_date, 'events_' || strftime(ts, '%Y-%m-%d') AS source_stem FROM events",
    "stream_by_header_name": """
SELECT event_id, ts, user_id, event_type, value, props, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS stem
FROM events""",
    "stream_event_columns": """
SELECT event_id, 'events_' || strftime(ts, '%Y-%m-%d') AS source_stem, CAST(ts AS DATE) AS key_day, CAST(ts AS DATE) AS uri_day,
       TRUE AS uri_is_bucket_and_key, CAST(ts AS DATE) AS day_if_on_time
FROM events""",
}
