"""Orders medallion: landing CSV -> silver -> gold (per business date) -> BI snapshot.

Written with the DataFrame API and the library's column functions; the HR
plan (:mod:`terrace.plans.hr`) shows the same chain written in SQL.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace import functions as TF
from terrace.contract import Contract, load_contracts
from terrace.plans.jobs import TableSpec
from terrace.run import RunContext

CONTRACTS: dict[str, Contract] = load_contracts(Path(__file__).parent / "contracts" / "orders.yaml")
SILVER = CONTRACTS["silver_orders"]
GOLD = CONTRACTS["gold_orders"]
BI = CONTRACTS["bi_orders_snapshot"]

# The bronze (landing) columns of an orders file.
BRONZE_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

# Order status text that counts as finished.
FINISHED_STATUS = ("f", "true")

# Label of each order priority rank.
PRIORITY_LABELS = {1: "urgent", 2: "high", 3: "medium", 4: "not_specified", 5: "low"}


def to_silver(bronze: DataFrame, run: RunContext) -> DataFrame:
    """Typed, trimmed, lower-cased orders with the run's lineage."""
    lineage = TF.lineage_columns(run)
    return bronze.select(
        TF.to_bigint("o_orderkey").alias("order_key"),
        TF.to_bigint("o_custkey").alias("customer_key"),
        TF.normalize_text("o_orderstatus").alias("order_status"),
        TF.yes_no("o_orderstatus", FINISHED_STATUS).alias("is_finished"),
        TF.to_decimal("o_totalprice").alias("total_price"),
        TF.iso_date_text("o_orderdate").alias("order_date"),
        TF.to_int(F.regexp_extract(F.trim(F.col("o_orderpriority")), r"^(\d+)", 1)).alias("priority_rank"),
        TF.normalize_text("o_orderpriority").alias("order_priority"),
        *[lineage[name].alias(name) for name in ("source_file", "run_id", "processed_at_utc")],
    )


def to_gold(silver: DataFrame, run: RunContext) -> DataFrame:
    """Renamed, labelled orders stamped with the run's business date."""
    dates = TF.business_date_columns(run.business_date)
    lineage = TF.lineage_columns(run, source_file=F.col("source_file"))
    return silver.select(
        F.col("order_key"),
        *[dates[name].alias(name) for name in ("ingestion_date", "year", "month", "day")],
        "customer_key",
        "order_status",
        "is_finished",
        "total_price",
        "order_date",
        F.col("priority_rank").alias("priority_score"),
        TF.score_label("priority_rank", PRIORITY_LABELS).alias("priority_label"),
        *[lineage[name].alias(name) for name in ("source_file", "run_id", "processed_at_utc")],
    )


def to_gold_history(silver: DataFrame, run: RunContext) -> DataFrame:
    """Gold for a frame spanning many days: each order goes to the folder of its own order date.

    Used to load history in one run; the run-date coherence rules do not apply.
    """
    dates = TF.business_date_columns(F.col("order_date"))
    return to_gold(silver, run).withColumns({name: dates[name] for name in ("ingestion_date", "year", "month", "day")})


def to_bi(gold: DataFrame, run: RunContext) -> DataFrame:
    """One business date of gold in the snapshot's column order.

    The equality filter on the partition columns prunes every other day's
    folder before any file is opened.
    """
    values = run.partition_values
    day = (F.col("year") == values["year"]) & (F.col("month") == values["month"]) & (F.col("day") == values["day"])
    return gold.where(day).select(*BI.names)


def silver_spec(path: str, **overrides) -> TableSpec:
    return TableSpec(contract=SILVER, path=path, **overrides)


def gold_spec(path: str, **overrides) -> TableSpec:
    options = dict(write_mode="overwrite_partition", partition_by=tuple(GOLD.partition_columns))
    options.update(overrides)
    return TableSpec(contract=GOLD, path=path, **options)


def bi_spec(path: str, fmt: str = "csv", **overrides) -> TableSpec:
    """The snapshot: a folder at a stable path, written in parallel (``layout="file"`` for one file)."""
    return TableSpec(contract=BI, path=path, fmt=fmt, check_run_date=False, **overrides)


def read_bronze(spark, path: str) -> DataFrame:
    """Landing orders CSV (header, all text); the header must name the bronze columns."""
    from terrace.sources import read_csv_strings

    return read_csv_strings(spark, path, BRONZE_COLUMNS, with_file_name=True)


def plan():
    from terrace.plans.chain import MedallionPlan

    return MedallionPlan("orders", read_bronze, to_silver, to_gold, to_bi, silver_spec, gold_spec, bi_spec)
