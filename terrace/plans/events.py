"""Events landing ingest: CSV files arriving in a folder -> silver events.

A micro-batch takes many landed files and is one run. Silver has a folder for
each event date and run, and a run replaces only its own folders: a replayed
batch rewrites the same rows, and files of the same day that came in different
batches never overwrite each other. A day's folders follow the number of
batches, not of files.
"""

from __future__ import annotations

import logging
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace import functions as TF
from terrace.contract import Contract, load_contracts
from terrace.plans.jobs import TableSpec, publish
from terrace.run import RunContext
from terrace.sinks import EmptyResultError
from terrace.streaming import ingest

log = logging.getLogger(__name__)

CONTRACTS: dict[str, Contract] = load_contracts(Path(__file__).parent / "contracts" / "events.yaml")
SILVER = CONTRACTS["silver_events"]

FILES_PER_BATCH = 1000

# The landing columns of an events file.
BRONZE_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def to_silver(bronze: DataFrame, run: RunContext) -> DataFrame:
    """Typed events; ``source_file`` is the landed file of each row."""
    source = F.col("source_filename") if "source_filename" in bronze.columns else F.col("_metadata.file_name")
    lineage = TF.lineage_columns(run, source_file=source)
    ts = F.try_to_timestamp(F.trim(F.col("ts")))
    return bronze.select(
        TF.to_bigint("event_id").alias("event_id"),
        ts.alias("ts"),
        TF.to_bigint("user_id").alias("user_id"),
        TF.normalize_text("event_type").alias("event_type"),
        F.col("value").try_cast("double").alias("value"),
        F.col("props"),
        TF.iso_date_text(F.col("ts")).alias("event_date"),
        *[lineage[name].alias(name) for name in ("source_file", "run_id", "processed_at_utc")],
    )


def silver_spec(path: str, **overrides) -> TableSpec:
    options = dict(write_mode="overwrite_partition", partition_by=("event_date", "run_id"), check_run_date=False)
    options.update(overrides)
    return TableSpec(contract=SILVER, path=path, **options)


def ingest_landing(
    spark: SparkSession,
    landing_dir: str,
    silver_path: str,
    checkpoint: str,
    *,
    glob: str = "*.csv",
    max_files_per_trigger: int = FILES_PER_BATCH,
    run_id: str | None = None,
) -> int:
    """E1: every waiting events file -> gated silver; batches of header-only files are skipped. Returns the batches."""

    def handle(batch: DataFrame, run: RunContext) -> None:
        try:
            publish(to_silver(batch, run), silver_spec(silver_path, rebalance=True), run, name="events_silver")
        except EmptyResultError:
            log.warning("Run %s: the landed files hold no rows; silver left untouched.", run.run_id)

    return ingest(spark, landing_dir, BRONZE_COLUMNS, checkpoint, handle, glob=glob, max_files_per_trigger=max_files_per_trigger, run_id=run_id)
