"""Registered queries over the driver's tables, one per operator family.

Every query reads whole tables from ``sf_dir`` (or data Spark derives from
them), runs the library operator, and returns a DataFrame. Queries that
exercise sinks write under the session's shared folder and return the
read-back of what they published. :mod:`terrace.oracles` holds, for each
query, SQL that computes the same result directly from the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace import catalog, sinks, sources
from terrace import functions as TF
from terrace import session as S
from terrace.contract import Contract
from terrace.operators import quality as Q
from terrace.plans import chain, events, orders
from terrace.plans.jobs import publish, read_published
from terrace.run import RunContext
from terrace.streaming import ingest, landing_stream

Query = Callable[[SparkSession, str], DataFrame]

# Fixed run values used by the registered queries, so results are comparable.
RUN_ID = "run-20260403"
PREVIOUS_RUN_ID = "run-20260402"
BACKFILL_RUN_ID = "backfill-20260402"
PROCESSED_AT = "2026-04-03 10:00:00"
BUSINESS_DATE = "2026-04-03"
PREVIOUS_DATE = "2026-04-02"
ORDERS_FILE = "orders.csv"
EVENTS_RUN_DATE = "2024-01-15"
PRUNE_DATE = (1998, 10, 3)
FILES_PER_BATCH = 10  # of the stream queries: several micro-batches of several files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _run(business_date: str = BUSINESS_DATE, run_id: str = RUN_ID, source_file: str | None = ORDERS_FILE) -> RunContext:
    return RunContext.create(business_date, run_id=run_id, processed_at_utc=PROCESSED_AT, source_file=source_file)


def _landed_run(business_date: str = BUSINESS_DATE, run_id: str = RUN_ID) -> RunContext:
    """A run without a source file: every row keeps the name of its own landing file."""
    return _run(business_date, run_id, None)


def _stem(df: DataFrame) -> DataFrame:
    """``orders-00003.csv`` -> ``orders.csv``: how many files were landed depends on the cluster; other names stay as they are."""
    return df.withColumn("source_file", F.regexp_replace("source_file", r"^orders-\d{5}\.csv$", ORDERS_FILE))


def _orders_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with every column as landing text (no file round trip)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        *[F.col(c).cast("string").alias(c) for c in orders.BRONZE_COLUMNS if c != "o_orderdate"],
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
    ).select(*orders.BRONZE_COLUMNS)


def _land_orders(spark: SparkSession, sf_dir: str, root: str) -> str:
    sources.land_files(table(spark, sf_dir, "orders").select(*orders.BRONZE_COLUMNS), f"{root}/landing", "orders")
    return f"{root}/landing/orders-*.csv"


def _orders_paths(root: str, landing: str) -> chain.MedallionPaths:
    return chain.MedallionPaths(landing=landing, silver=f"{root}/silver", gold=f"{root}/gold", bi=f"{root}/bi/orders_snapshot")


def _gold_days(spark: SparkSession, sf_dir: str, root: str, days: list[tuple[str, str]]) -> str:
    """Gold orders written for several business dates (each a dynamic partition overwrite)."""
    silver = orders.to_silver(_orders_as_text(spark, sf_dir), _run())
    gold_path = f"{root}/gold"
    for business_date, run_id in days:
        run = _run(business_date, run_id)
        publish(orders.to_gold(silver, run), orders.gold_spec(gold_path), run, name="orders_gold")
    return gold_path


# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------


def csv_bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "csv_bronze_scan")
    sources.land_files(table(spark, sf_dir, "customer"), f"{root}/landing", "customer")
    bronze = sources.read_csv_strings(spark, f"{root}/landing/customer-*.csv")
    return bronze.select(
        TF.to_bigint("c_custkey").alias("c_custkey"),
        TF.normalize_text("c_name").alias("c_name"),
        TF.to_int("c_nationkey").alias("c_nationkey"),
        TF.to_decimal("c_acctbal").alias("c_acctbal"),
        TF.normalize_text("c_mktsegment").alias("c_mktsegment"),
    )


def landing_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "landing_file_scan")
    prefix = f"{root}/landing/"
    sources.land_files(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), prefix, "customer")
    sources.land_files(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), prefix, "supplier")
    path = sources.resolve_landing_source(prefix, "customer-*.csv")
    df = sources.read_csv_strings(spark, path, ["c_custkey", "c_name"], with_file_name=True)
    return df.select(
        TF.to_bigint("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.regexp_extract("_source_file", r"^([a-z]+)-\d+\.csv$", 1).alias("source_stem"),
    )


def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "parquet_scan")
    sinks.overwrite_full(table(spark, sf_dir, "part"), f"{root}/part/landing/2026/04/03")
    return sources.read_parquet(spark, f"{root}/part", recursive=True)


def _orders_by_order_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = TF.business_date_columns(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").withColumns({k: dates[k] for k in ("year", "month", "day")})


def partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "partition_scan")
    sinks.overwrite_full(_orders_by_order_date(spark, sf_dir), f"{root}/orders", partition_by=("year", "month", "day"), rebalance=True)
    return sources.read_partitioned(spark, f"{root}/orders")


def partition_prune_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "partition_prune_filter")
    sinks.overwrite_full(_orders_by_order_date(spark, sf_dir), f"{root}/orders", partition_by=("year", "month", "day"), rebalance=True)
    year, month, day = PRUNE_DATE
    df = sources.read_partitioned(spark, f"{root}/orders")
    return df.where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))


def sql_parameterized(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        SELECT l_orderkey, l_linenumber, l_quantity,
               l_extendedprice * (1 - l_discount) AS net_price,
               l_shipdate >= CAST(:cutoff AS TIMESTAMP_NTZ) AS shipped_after_cutoff,
               CAST(:run_id AS STRING) AS run_id,
               CAST(:business_date AS DATE) AS business_date
        FROM {source}
    """
    args = {"cutoff": "1998-01-01 00:00:00", "run_id": RUN_ID, "business_date": BUSINESS_DATE}
    return sources.sql_over(spark, text, args, source=table(spark, sf_dir, "lineitem"))


# ---------------------------------------------------------------------------
# Sinks
# ---------------------------------------------------------------------------


def parquet_full_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "parquet_full_overwrite")
    customer = table(spark, sf_dir, "customer")
    sinks.overwrite_full(customer, f"{root}/customer")
    sinks.overwrite_full(customer.withColumn("c_name", F.upper("c_name")), f"{root}/customer")
    return sources.read_parquet(spark, f"{root}/customer")


def partition_full_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "partition_full_overwrite")
    path = f"{root}/orders"
    sinks.overwrite_full(_orders_by_order_date(spark, sf_dir), path, partition_by=("year", "month", "day"), rebalance=True)
    stamped = TF.business_date_columns(BUSINESS_DATE)
    restamped = table(spark, sf_dir, "orders").withColumns({k: stamped[k] for k in ("year", "month", "day")})
    sinks.overwrite_full(restamped, path, partition_by=("year", "month", "day"))
    return sources.read_partitioned(spark, path)


def partition_overwrite_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "partition_overwrite_day")
    path = f"{root}/orders"
    o = table(spark, sf_dir, "orders")

    def stamp(df: DataFrame, day: str) -> DataFrame:
        cols = TF.business_date_columns(day)
        return df.withColumns({k: cols[k] for k in ("year", "month", "day")})

    sinks.overwrite_partitions(stamp(o, PREVIOUS_DATE), path, ("year", "month", "day"))
    sinks.overwrite_partitions(stamp(o, BUSINESS_DATE), path, ("year", "month", "day"))
    sinks.overwrite_partitions(stamp(o.withColumn("o_totalprice", F.col("o_totalprice") + 1), BUSINESS_DATE), path, ("year", "month", "day"))
    return sources.read_partitioned(spark, path)


def _snapshot(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    root = S.scratch_path(spark, f"snapshot_{fmt}")
    gold = _gold_days(spark, sf_dir, root, [(PREVIOUS_DATE, PREVIOUS_RUN_ID), (BUSINESS_DATE, RUN_ID)])
    run = _run()
    spec = orders.bi_spec(f"{root}/bi/orders_snapshot.{fmt}", fmt=fmt, layout="file")
    publish(orders.to_bi(sources.read_partitioned(spark, gold), run), spec, run, name="orders_bi", inputs=[gold])
    return read_published(spark, spec)


def snapshot_csv_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV snapshot of one day as one file at its stable path."""
    return _snapshot(spark, sf_dir, "csv")


def snapshot_parquet_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Parquet snapshot of one day as one file at its stable path."""
    return _snapshot(spark, sf_dir, "parquet")


def csv_dataset_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "csv_dataset_sink")
    customer = table(spark, sf_dir, "customer")
    sinks.overwrite_full(customer, f"{root}/customer", fmt="csv", partition_by=("c_mktsegment",), rebalance=True)
    return spark.read.schema(customer.schema).options(**sinks.CSV_OPTIONS).option("basePath", f"{root}/customer").csv(f"{root}/customer")


def sink_readback_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each month's folder after a publish (whose own read-back compares every folder), beside those checked.

    A folder whose rows have other values than those checked counts as not read.
    """
    root = S.scratch_path(spark, "sink_readback_count")
    parts = ("year", "month")
    gold = orders.to_gold_history(orders.to_silver(_orders_as_text(spark, sf_dir), _run()), _run())
    spec = orders.gold_spec(f"{root}/gold", write_mode="overwrite_full", partition_by=parts, check_run_date=False, rebalance=True, readback="content")
    publish(gold, spec, _run())
    written = sinks.content_sums(gold, parts)
    read = sinks.content_sums(read_published(spark, spec), parts)
    same = F.col("written.content").eqNullSafe(F.col("read.content"))
    joined = written.alias("written").join(read.alias("read"), list(parts), "full_outer")
    return joined.select(
        *parts, F.coalesce("written.rows", F.lit(0)).alias("rows_written"), F.when(same, F.col("read.rows")).otherwise(F.lit(0)).alias("rows_read")
    )


def numeric_partition_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "numeric_partition_layout")
    dates = TF.business_date_columns(F.col("ts"))
    ev = table(spark, sf_dir, "events").withColumns({k: dates[k] for k in ("year", "month", "day")})
    sinks.overwrite_numeric_partitions(ev, f"{root}/events", ("year", "month", "day"))
    return sources.read_numeric_partitions(spark, f"{root}/events", ("year", "month", "day"))


# ---------------------------------------------------------------------------
# Table jobs and chain
# ---------------------------------------------------------------------------


def silver_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "silver_normalize")
    paths = _orders_paths(root, _land_orders(spark, sf_dir, root))
    chain.run_silver(spark, orders.plan(), paths, _landed_run())
    return _stem(sources.read_parquet(spark, paths.silver))


def gold_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "gold_enrich")
    paths = _orders_paths(root, _land_orders(spark, sf_dir, root))
    run = _landed_run()
    chain.run_silver(spark, orders.plan(), paths, run)
    chain.run_gold(spark, orders.plan(), paths, run)
    return _stem(sources.read_partitioned(spark, paths.gold))


def bi_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "bi_snapshot")
    paths = _orders_paths(root, _land_orders(spark, sf_dir, root))
    plan = orders.plan()
    chain.run_chain(spark, plan, paths, _landed_run(PREVIOUS_DATE, PREVIOUS_RUN_ID))
    chain.run_chain(spark, plan, paths, _landed_run())
    return _stem(read_published(spark, orders.bi_spec(paths.bi)))


def medallion_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "medallion_chain")
    paths = _orders_paths(root, _land_orders(spark, sf_dir, root))
    plan = orders.plan()
    chain.run_chain(spark, plan, paths, _landed_run(PREVIOUS_DATE, PREVIOUS_RUN_ID))
    chain.run_chain(spark, plan, paths, _landed_run())
    return _stem(sources.read_partitioned(spark, paths.gold))


def backfill_business_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "backfill_business_date")
    paths = _orders_paths(root, _land_orders(spark, sf_dir, root))
    plan = orders.plan()
    chain.run_chain(spark, plan, paths, _landed_run(PREVIOUS_DATE, PREVIOUS_RUN_ID))
    chain.run_chain(spark, plan, paths, _landed_run())
    backfill_paths = chain.MedallionPaths(paths.landing, paths.silver, paths.gold)
    chain.backfill(spark, plan, backfill_paths, PREVIOUS_DATE, run_id=BACKFILL_RUN_ID, processed_at_utc=PROCESSED_AT)
    return _stem(sources.read_partitioned(spark, paths.gold))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "run_summary")
    run = _run()
    silver = orders.to_silver(_orders_as_text(spark, sf_dir), run)
    spec = orders.gold_spec(f"{root}/gold", write_mode="overwrite_full", check_run_date=False, rebalance=True)
    publish(orders.to_gold_history(silver, run), spec, run, name="orders_gold_history")
    return chain.run_partition_summary(spark, spec, run, "orders_gold_history")


def chain_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two one-day chains that share a run id, audited to one table that is then merged: rows of each pipeline's partition."""
    root = S.scratch_path(spark, "chain_audit")
    schema = T.StructType.fromDDL("pipeline string, run_id string, year int, month int, day int, rows_written bigint")
    landing = _land_orders(spark, sf_dir, root)
    for name, business_date in (("orders_a", PREVIOUS_DATE), ("orders_b", BUSINESS_DATE)):
        paths = chain.MedallionPaths(landing, f"{root}/{name}/silver", f"{root}/{name}/gold")
        chain.run_chain(spark, replace(orders.plan(), name=name), paths, _landed_run(business_date), audit_root=f"{root}/audit")
        chain.compact_audit(spark, f"{root}/audit/partitions", schema)
    return chain.read_audit(spark, f"{root}/audit/partitions", schema)


def csv_by_header_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landing files with different column orders, one with a further column, read by header name."""
    root = S.scratch_path(spark, "csv_by_header_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    even = F.col("c_custkey") % 2 == 0
    sources.land_files(customer.where(even), f"{root}/landing", "a")
    turned = customer.where(~even).select("c_acctbal", "c_nationkey", F.lit("x,y").alias("remark"), "c_name", "c_custkey")
    sources.land_files(turned, f"{root}/landing", "b")
    rows = sources.read_csv_strings(spark, f"{root}/landing/*.csv", ["c_custkey", "c_name", "c_nationkey", "c_acctbal"], with_file_name=True)
    return rows.select(
        TF.to_bigint("c_custkey").alias("c_custkey"),
        "c_name",
        TF.to_int("c_nationkey").alias("c_nationkey"),
        TF.to_decimal("c_acctbal").alias("c_acctbal"),
        F.substring(TF.SOURCE_COLUMN, 1, 1).alias("stem"),
    )


def silver_normalize_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders silver step written as a SQL file (typed parameters, bound source)."""
    from pathlib import Path

    from terrace.plans.jobs import sql_transform

    root = S.scratch_path(spark, "silver_normalize_sql")
    landing = _land_orders(spark, sf_dir, root)
    text = (Path(orders.__file__).parent / "sql" / "orders_silver.sql").read_text(encoding="utf-8")
    run = _landed_run()
    publish(sql_transform(text)(orders.read_bronze(spark, landing), run), orders.silver_spec(f"{root}/silver"), run, inputs=[landing])
    return _stem(sources.read_parquet(spark, f"{root}/silver"))


def silver_gate_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver published as a version, gated while it is written (the large-result path)."""
    root = S.scratch_path(spark, "silver_gate_observed")
    landing = _land_orders(spark, sf_dir, root)
    run = _run()
    silver = orders.to_silver(orders.read_bronze(spark, landing), run)
    spec = orders.silver_spec(f"{root}/silver", gate="observe")
    publish(silver, spec, run, inputs=[landing])
    return read_published(spark, spec)


def gold_gate_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two gold days published as versions, the second day twice: its last version is the one that is read."""
    root = S.scratch_path(spark, "gold_gate_observed")
    silver = orders.to_silver(_orders_as_text(spark, sf_dir), _run())
    spec = orders.gold_spec(f"{root}/gold", gate="observe")
    for business_date, run_id in ((PREVIOUS_DATE, PREVIOUS_RUN_ID), (BUSINESS_DATE, "superseded"), (BUSINESS_DATE, RUN_ID)):
        run = _run(business_date, run_id)
        publish(orders.to_gold(silver, run), spec, run)
    return read_published(spark, spec)


def gold_numeric_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two gold days published in the numeric layout (``root/2026/4/3``), values read back from the paths."""
    root = S.scratch_path(spark, "gold_numeric_publish")
    silver = orders.to_silver(_orders_as_text(spark, sf_dir), _run())
    for business_date, run_id in ((PREVIOUS_DATE, PREVIOUS_RUN_ID), (BUSINESS_DATE, RUN_ID)):
        run = _run(business_date, run_id)
        publish(orders.to_gold(silver, run), orders.gold_spec(f"{root}/gold", partition_style="numeric"), run)
    back = sources.read_numeric_partitions(spark, f"{root}/gold", orders.GOLD.partition_columns)
    return back.select(*orders.GOLD.names)


def catalog_registered_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold days published with catalog registration wired into the job (C1/C2 + K3)."""
    root = S.scratch_path(spark, "catalog_registered_publish")
    table_name = f"{_database(spark, 'registered')}.gold_orders"
    silver = orders.to_silver(_orders_as_text(spark, sf_dir), _run())
    for business_date, run_id in ((PREVIOUS_DATE, PREVIOUS_RUN_ID), (BUSINESS_DATE, RUN_ID)):
        run = _run(business_date, run_id)
        publish(orders.to_gold(silver, run), orders.gold_spec(f"{root}/gold", catalog_table=table_name), run)
    return spark.table(table_name)


def catalog_numeric_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold days in the numeric layout, read through the catalog: partitions are registered with their folders."""
    root = S.scratch_path(spark, "catalog_numeric_publish")
    table_name = f"{_database(spark, 'numeric')}.gold_orders"
    silver = orders.to_silver(_orders_as_text(spark, sf_dir), _run())
    for business_date, run_id in ((PREVIOUS_DATE, PREVIOUS_RUN_ID), (BUSINESS_DATE, RUN_ID)):
        run = _run(business_date, run_id)
        publish(orders.to_gold(silver, run), orders.gold_spec(f"{root}/gold", partition_style="numeric", catalog_table=table_name), run)
    return spark.table(table_name)


def catalog_synced_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions that the catalog shows after a full overwrite with another day, with their rows."""
    root = S.scratch_path(spark, "catalog_synced_partitions")
    table_name = f"{_database(spark, 'synced')}.gold_orders"
    silver = orders.to_silver(_orders_as_text(spark, sf_dir), _run())
    for business_date, run_id in ((PREVIOUS_DATE, PREVIOUS_RUN_ID), (BUSINESS_DATE, RUN_ID)):
        run = _run(business_date, run_id)
        publish(orders.to_gold(silver, run), orders.gold_spec(f"{root}/gold", write_mode="overwrite_full", catalog_table=table_name), run)
    rows = spark.table(table_name).agg(F.count(F.lit(1)).alias("row_count"))
    return spark.sql(f"SHOW PARTITIONS {table_name}").crossJoin(F.broadcast(rows))


def chain_catalog_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain's last step: the catalog count after two days were loaded."""
    root = S.scratch_path(spark, "chain_catalog_count")
    paths = replace(_orders_paths(root, _land_orders(spark, sf_dir, root)), bi=None, table=f"{_database(spark, 'chain')}.gold_orders")
    counts = []
    for business_date, run_id in ((PREVIOUS_DATE, PREVIOUS_RUN_ID), (BUSINESS_DATE, RUN_ID)):
        done = chain.run_chain(spark, orders.plan(), paths, _landed_run(business_date, run_id))
        counts.append((done["business_date"], done["catalog"]["row_count"]))
    return spark.createDataFrame(counts, "business_date string, row_count long")


# ---------------------------------------------------------------------------
# Column functions
# ---------------------------------------------------------------------------


def cast_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        TF.to_bigint(F.col("l_orderkey").cast("string")).alias("l_orderkey"),
        TF.to_int(F.col("l_linenumber").cast("string")).alias("l_linenumber"),
        TF.to_int(F.concat(F.lit(" "), F.col("l_linenumber").cast("string"), F.lit(" "))).alias("padded_linenumber"),
        TF.to_int("l_returnflag").alias("returnflag_as_int"),
    )


def cast_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        TF.to_decimal(F.col("l_extendedprice").cast("string")).alias("extended_price"),
        TF.to_decimal(F.col("l_tax").cast("string")).alias("tax"),
        TF.to_decimal("l_returnflag").alias("returnflag_as_decimal"),
    )


def flag_yes_no(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        "o_orderstatus",
        TF.yes_no("o_orderstatus", orders.FINISHED_STATUS).alias("is_finished"),
        TF.yes_no("o_orderstatus").alias("is_yes"),
        TF.yes_no(F.nullif(F.col("o_orderstatus"), F.lit("P")), ("p",)).alias("null_is_false"),
    )


def score_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", TF.score_label("l_linenumber").alias("linenumber_label"))


def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineage = TF.lineage_columns(_run())
    return table(spark, sf_dir, "orders").select("o_orderkey", *[v.alias(k) for k, v in lineage.items()])


def business_date_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = TF.business_date_columns(F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", *[v.alias(k) for k, v in dates.items()])


def iso_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        TF.iso_date_text(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("date_from_t"),
        TF.iso_date_text(F.col("ts").cast("string")).alias("date_from_space"),
        TF.iso_date_text(F.date_format("ts", "yyyy-MM-dd")).alias("date_only"),
        TF.iso_date_text(F.when(F.col("event_type") != "error", F.col("ts").cast("string")).otherwise(" "), F.lit(BUSINESS_DATE)).alias("empty_is_run_date"),
    )


def path_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", TF.file_name("url").alias("file_name"))


# ---------------------------------------------------------------------------
# Quality rules
# ---------------------------------------------------------------------------

# Contract used by the quality queries over lineitem (rules chosen so several fire).
LINEITEM_CHECKS = Contract.from_dict(
    "lineitem_checks",
    {
        "primary_key": ["l_orderkey", "l_linenumber"],
        "columns": [
            {"name": "l_orderkey", "type": "bigint", "nullable": False},
            {"name": "l_linenumber", "type": "integer", "nullable": False, "min_value": 1, "max_value": 6},
            {"name": "l_quantity", "type": "double", "nullable": False, "min_value": 5, "max_value": 45},
            {"name": "l_tax", "type": "double", "nullable": False, "max_value": 0.05},
            {"name": "l_returnflag", "type": "string", "nullable": False, "allowed_values": ["A", "N", "R"]},
            {"name": "l_linestatus", "type": "string", "nullable": False, "allowed_values": ["F"]},
            {"name": "l_shipdate", "type": "timestamp", "nullable": False},
        ],
    },
)

EVENTS_CHECKS = Contract.from_dict(
    "events_checks",
    {
        "partition_columns": ["year", "month", "day"],
        "columns": [
            {"name": "event_id", "type": "bigint", "nullable": False},
            {"name": "user_id", "type": "bigint", "nullable": False},
            {"name": "event_type", "type": "string", "nullable": False},
            {"name": "value", "type": "double", "nullable": False},
            {"name": "props", "type": "string", "nullable": False},
            {"name": "ingestion_date", "type": "date", "nullable": False},
            {"name": "year", "type": "integer", "nullable": False},
            {"name": "month", "type": "integer", "nullable": False},
            {"name": "day", "type": "integer", "nullable": False},
        ],
    },
)

# Part sizes and brands accepted by the domain query.
PART_SIZE_DOMAIN = [str(size) for size in range(1, 46)]
PART_BRAND_DOMAIN = ["Brand#11", "Brand#12", "Brand#13"]

PART_CHECKS = Contract.from_dict(
    "part_checks",
    {
        "columns": [
            {"name": "p_partkey", "type": "bigint"},
            {"name": "p_brand", "type": "string", "allowed_values": PART_BRAND_DOMAIN},
            {"name": "p_size", "type": "integer", "allowed_values": PART_SIZE_DOMAIN},
        ]
    },
)


def _events_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = TF.business_date_columns(F.col("ts"))
    ev = table(spark, sf_dir, "events").withColumn("event_type", F.nullif(F.col("event_type"), F.lit("error")))
    return ev.select(*[c for c in EVENTS_CHECKS.names if c not in dates], *[dates[k].alias(k) for k in ("ingestion_date", "year", "month", "day")])


def _rules(df: DataFrame, contract: Contract, rule: str, run: RunContext | None = None) -> DataFrame:
    """The report of one kind of rule; no other is compiled."""
    report = Q.quality_report(df, contract, run, only=(rule,))
    return report.where("rule_order > 0").select("rule", "column_name", "violations")


def quality_pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicate_key_groups(table(spark, sf_dir, "lineitem"), ("l_orderkey", "l_linenumber"))


def quality_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(_events_checked(spark, sf_dir), EVENTS_CHECKS, "non_null")


def quality_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(*PART_CHECKS.names)
    return _rules(part, PART_CHECKS, "domain")


def quality_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*LINEITEM_CHECKS.names)
    return _rules(li, LINEITEM_CHECKS, "range")


def quality_ingestion_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = RunContext.create(EVENTS_RUN_DATE, run_id=RUN_ID, processed_at_utc=PROCESSED_AT)
    return _rules(_events_checked(spark, sf_dir), EVENTS_CHECKS, "ingestion_date", run)


def quality_partition_coherence(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = RunContext.create(EVENTS_RUN_DATE, run_id=RUN_ID, processed_at_utc=PROCESSED_AT)
    return _rules(_events_checked(spark, sf_dir), EVENTS_CHECKS, "partition", run)


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*LINEITEM_CHECKS.names)
    return Q.quality_report(li, LINEITEM_CHECKS)


# ---------------------------------------------------------------------------
# Catalog
# ---------------------------------------------------------------------------


def _database(spark: SparkSession, name: str) -> str:
    """A fresh database whose folder is under the shared root (not the local warehouse)."""
    database = f"terrace_{name}_{uuid.uuid4().hex[:10]}"
    catalog.ensure_database(spark, database, location=f"{S.shared_root(spark)}/terrace/warehouse/{database}.db")
    return database


def catalog_external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "catalog_external_table")
    run = _run()
    publish(orders.to_silver(_orders_as_text(spark, sf_dir), run), orders.silver_spec(f"{root}/silver"), run)
    table_name = f"{_database(spark, 'silver')}.silver_orders"
    catalog.register_external_table(spark, table_name, orders.SILVER, f"{root}/silver")
    return spark.table(table_name)


def _catalog_gold(spark: SparkSession, sf_dir: str, name: str) -> str:
    root = S.scratch_path(spark, name)
    gold = _gold_days(spark, sf_dir, root, [(PREVIOUS_DATE, PREVIOUS_RUN_ID), (BUSINESS_DATE, RUN_ID), ("2036-01-01", "run-20360101")])
    table_name = f"{_database(spark, name)}.gold_orders"
    catalog.register_external_table(spark, table_name, orders.GOLD, gold)
    for business_date in (PREVIOUS_DATE, BUSINESS_DATE, "2036-01-01"):
        catalog.add_partition(spark, table_name, _run(business_date).partition_values)
    return table_name


def catalog_partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_name = _catalog_gold(spark, sf_dir, "catalog_partitioned_table")
    view = table_name.replace(".", "_") + "_projected"
    return catalog.projected_view(spark, view, table_name, {"year": (2024, 2035), "month": (1, 12), "day": (1, 31)})


def catalog_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.row_count(spark, _catalog_gold(spark, sf_dir, "catalog_row_count"))


# ---------------------------------------------------------------------------
# Streaming
# ---------------------------------------------------------------------------


def _land_events(spark: SparkSession, sf_dir: str, landing: str) -> None:
    ev = table(spark, sf_dir, "events")
    dated = ev.select(*events.BRONZE_COLUMNS, F.to_date("ts").cast("string").alias("event_date"))
    sources.land_files(dated, landing, "events", by="event_date")
    # A non-CSV file in the same folder must be ignored by the ingest.
    sources.land_files(ev.select(F.to_json(F.struct(*ev.columns)).alias("value")), landing, "events_dump", fmt="text")


def stream_landing_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = S.scratch_path(spark, "stream_landing_ingest")
    _land_events(spark, sf_dir, f"{root}/landing")
    events.ingest_landing(spark, f"{root}/landing", f"{root}/silver", f"{root}/_checkpoint", max_files_per_trigger=FILES_PER_BATCH)
    silver = sources.read_table(spark, f"{root}/silver", events.SILVER.schema)
    stem = F.regexp_extract("source_file", r"^(events_\d{4}-\d{2}-\d{2})-\d{5}\.csv$", 1)
    return silver.select("event_id", "ts", "user_id", "event_type", "value", "props", "event_date", stem.alias("source_stem"))


def stream_event_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival columns of every landed row, and the run id given to the ingest."""
    root = S.scratch_path(spark, "stream_event_columns")
    started = spark.range(1).select(F.current_timestamp()).first()[0]
    _land_events(spark, sf_dir, f"{root}/landing")
    day_of = r"events_(\d{4}-\d{2}-\d{2})-\d{5}\.csv$"
    arrivals = landing_stream(spark, f"{root}/landing", events.BRONZE_COLUMNS, max_files_per_trigger=FILES_PER_BATCH).select(
        TF.to_bigint("event_id").alias("event_id"),
        F.regexp_extract("source_filename", r"^(events_\d{4}-\d{2}-\d{2})-\d{5}\.csv$", 1).alias("source_stem"),
        F.to_date(F.regexp_extract("object_key", day_of, 1)).alias("key_day"),
        F.to_date(F.regexp_extract("source_uri", day_of, 1)).alias("uri_day"),
        F.concat(F.lit(f"{urlsplit(S.qualified(spark, root)).scheme}://"), "bucket_name", F.lit("/"), "object_key").alias("built_uri"),
        "source_uri",
        "event_time",
        "business_date",
    )
    query = arrivals.writeStream.format("parquet").option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start(f"{root}/arrivals")
    query.awaitTermination()
    out = spark.read.parquet(f"{root}/arrivals")
    # Files land after this query began (file times have whole seconds).
    on_time = F.col("event_time") >= F.date_trunc("second", F.lit(started))
    return out.select(
        "event_id",
        "source_stem",
        "key_day",
        "uri_day",
        (F.regexp_replace("built_uri", "/+", "/") == F.regexp_replace("source_uri", "/+", "/")).alias("uri_is_bucket_and_key"),
        F.when(on_time & (F.col("business_date") == F.to_date("event_time")), F.col("uri_day")).alias("day_if_on_time"),
    )


def stream_explicit_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed orders run through the chain by the stream, with a given business date and run id (a retry)."""
    root = S.scratch_path(spark, "stream_explicit_run")
    _land_orders(spark, sf_dir, root)
    handler = chain.arrival_handler(orders.plan(), f"{root}/silver", f"{root}/gold", bronze_columns=orders.BRONZE_COLUMNS, audit_root=f"{root}/audit")
    # Every part is a file of the same name in a folder of its own, and all are one arrival batch.
    landed = S.matching_files(spark, f"{root}/landing/orders-*.csv")
    S.move_all(spark, [(place, f"{root}/arrived/{n}/orders-00000.csv") for n, place in enumerate(landed)])
    ingest(spark, f"{root}/arrived/*", orders.BRONZE_COLUMNS, f"{root}/_checkpoint", handler, max_files_per_trigger=len(landed), business_date=PREVIOUS_DATE, run_id=BACKFILL_RUN_ID)
    gold = sources.read_partitioned(spark, f"{root}/gold")
    audit = spark.read.parquet(f"{root}/audit/partitions").select("run_id", "year", "month", "day", "rows_written")
    return gold.join(audit, ["run_id", "year", "month", "day"]).select("order_key", "source_file", "run_id", "ingestion_date", "year", "month", "day", "rows_written")


def stream_by_header_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed with different column orders, some with a further column, ingested by the stream and bound by header name."""
    root = S.scratch_path(spark, "stream_by_header_name")
    ev = table(spark, sf_dir, "events")
    even = F.col("event_id") % 2 == 0
    sources.land_files(ev.where(even).select(*events.BRONZE_COLUMNS), f"{root}/landing", "a")
    turned = ev.where(~even).select(F.lit('say "x,y"').alias("remark"), *reversed(events.BRONZE_COLUMNS))
    sources.land_files(turned, f"{root}/landing", "b")
    events.ingest_landing(spark, f"{root}/landing", f"{root}/silver", f"{root}/_checkpoint")
    silver = sources.read_table(spark, f"{root}/silver", events.SILVER.schema)
    return silver.select("event_id", "ts", "user_id", "event_type", "value", "props", F.substring("source_file", 1, 1).alias("stem"))


QUERIES: dict[str, Query] = {
    "stream_by_header_name": stream_by_header_name,
    "csv_bronze_scan": csv_bronze_scan,
    "landing_file_scan": landing_file_scan,
    "parquet_scan": parquet_scan,
    "partition_scan": partition_scan,
    "partition_prune_filter": partition_prune_filter,
    "sql_parameterized": sql_parameterized,
    "parquet_full_overwrite": parquet_full_overwrite,
    "partition_full_overwrite": partition_full_overwrite,
    "partition_overwrite_day": partition_overwrite_day,
    "snapshot_csv_single_file": snapshot_csv_single_file,
    "snapshot_parquet_single_file": snapshot_parquet_single_file,
    "csv_dataset_sink": csv_dataset_sink,
    "sink_readback_count": sink_readback_count,
    "numeric_partition_layout": numeric_partition_layout,
    "silver_normalize": silver_normalize,
    "gold_enrich": gold_enrich,
    "bi_snapshot": bi_snapshot,
    "medallion_chain": medallion_chain,
    "backfill_business_date": backfill_business_date,
    "run_summary": run_summary,
    "silver_normalize_sql": silver_normalize_sql,
    "silver_gate_observed": silver_gate_observed,
    "gold_gate_observed": gold_gate_observed,
    "catalog_registered_publish": catalog_registered_publish,
    "gold_numeric_publish": gold_numeric_publish,
    "cast_integer": cast_integer,
    "cast_decimal": cast_decimal,
    "flag_yes_no": flag_yes_no,
    "score_label": score_label,
    "lineage_columns": lineage_columns,
    "business_date_columns": business_date_columns,
    "iso_date_parse": iso_date_parse,
    "path_file_name": path_file_name,
    "quality_pk_duplicates": quality_pk_duplicates,
    "quality_non_null": quality_non_null,
    "quality_domain": quality_domain,
    "quality_range": quality_range,
    "quality_ingestion_date": quality_ingestion_date,
    "quality_partition_coherence": quality_partition_coherence,
    "quality_report": quality_report,
    "catalog_external_table": catalog_external_table,
    "catalog_partitioned_table": catalog_partitioned_table,
    "catalog_row_count": catalog_row_count,
    "stream_landing_ingest": stream_landing_ingest,
    "stream_event_columns": stream_event_columns,
    "stream_explicit_run": stream_explicit_run,
    "chain_audit": chain_audit,
    "chain_catalog_count": chain_catalog_count,
    "csv_by_header_name": csv_by_header_name,
    "catalog_numeric_publish": catalog_numeric_publish,
    "catalog_synced_partitions": catalog_synced_partitions,
}
