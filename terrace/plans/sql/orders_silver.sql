-- Landing orders (all text) -> typed silver rows; the SQL form of plans.orders.to_silver.
-- Bound by the caller: {source} (the landing rows with their _source_file), :source_file (or NULL), :run_id, :processed_at_utc.
SELECT
  try_cast(o_orderkey AS BIGINT)                                              AS order_key,
  try_cast(o_custkey AS BIGINT)                                               AS customer_key,
  trim(lower(o_orderstatus))                                                  AS order_status,
  coalesce(trim(lower(o_orderstatus)) IN ('f', 'true'), false)                AS is_finished,
  try_cast(o_totalprice AS DECIMAL(12, 2))                                    AS total_price,
  try_to_date(regexp_extract(trim(o_orderdate), '^([^T ]*)', 1), 'yyyy-MM-dd') AS order_date,
  try_cast(regexp_extract(trim(o_orderpriority), '^([0-9]+)', 1) AS INT)      AS priority_rank,
  trim(lower(o_orderpriority))                                                AS order_priority,
  coalesce(CAST(:source_file AS STRING), _source_file) AS source_file,
  CAST(:run_id AS STRING)                                                     AS run_id,
  CAST(:processed_at_utc AS TIMESTAMP)                                        AS processed_at_utc
FROM {source}
