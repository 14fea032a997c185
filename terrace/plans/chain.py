"""Medallion chain (bronze -> silver -> gold -> BI), backfill and run audit.

Each step reads what the previous step published (a fresh ``spark.read``, so
the listing reflects the write) and all steps share one run id and
processing time. A failing step raises and the later steps do not run.
"""

from __future__ import annotations

import datetime as dt
import functools
import logging
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace import catalog
from terrace import functions as TF
from terrace import session as S
from terrace.plans.jobs import JobResult, TableSpec, Transform, publish, read_published
from terrace.run import Arrival, RunContext
from terrace.sinks import versions

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class MedallionPlan:
    """The tables and transforms of one medallion chain."""

    name: str
    read_bronze: Callable[[SparkSession, str], DataFrame]
    to_silver: Transform
    to_gold: Transform
    to_bi: Transform
    silver_spec: Callable[[str], TableSpec]
    gold_spec: Callable[[str], TableSpec]
    bi_spec: Callable[[str], TableSpec]


@dataclass(frozen=True)
class MedallionPaths:
    landing: str
    silver: str
    gold: str
    bi: str | None = None
    table: str | None = None  # catalog table over gold, counted as the chain's last step


def run_silver(spark: SparkSession, plan: MedallionPlan, paths: MedallionPaths, run: RunContext) -> JobResult:
    bronze = plan.read_bronze(spark, paths.landing)
    return publish(plan.to_silver(bronze, run), plan.silver_spec(paths.silver), run, name=f"{plan.name}_silver", inputs=[paths.landing])


def run_gold(spark: SparkSession, plan: MedallionPlan, paths: MedallionPaths, run: RunContext) -> JobResult:
    silver = read_published(spark, plan.silver_spec(paths.silver))
    spec = plan.gold_spec(paths.gold)
    if paths.table:
        spec = replace(spec, catalog_table=paths.table)
    return publish(plan.to_gold(silver, run), spec, run, name=f"{plan.name}_gold", inputs=[paths.silver])


def run_bi(spark: SparkSession, plan: MedallionPlan, paths: MedallionPaths, run: RunContext) -> JobResult:
    if not paths.bi:
        raise ValueError("No BI target was given.")
    gold = read_published(spark, plan.gold_spec(paths.gold))
    return publish(plan.to_bi(gold, run), plan.bi_spec(paths.bi), run, name=f"{plan.name}_bi", inputs=[paths.gold])


def run_gold_days(spark: SparkSession, plan: MedallionPlan, paths: MedallionPaths, runs: Sequence[RunContext]) -> JobResult:
    """Gold for several runs of one silver table, which tells their rows by run id: one gated write of all their days.

    Each run's rows are stamped with its own date, so the partition of a row
    follows from its run.
    """
    silver = read_published(spark, plan.silver_spec(paths.silver))
    days = [plan.to_gold(silver.where(F.col("run_id") == F.lit(run.run_id)), run) for run in runs]
    spec = replace(plan.gold_spec(paths.gold), check_run_date=False, rebalance=True)
    if paths.table:
        spec = replace(spec, catalog_table=paths.table)
    return publish(functools.reduce(DataFrame.unionByName, days), spec, runs[-1], name=f"{plan.name}_gold", inputs=[paths.silver])


def _after_silver(spark: SparkSession, plan: MedallionPlan, paths: MedallionPaths, run: RunContext, silver: JobResult, audit_root: str | None, runs: Sequence[RunContext] = ()) -> dict[str, Any]:
    """The steps that every form of the chain shares once silver is published; ``runs`` are the batch's if there are several."""
    several = len(runs) > 1
    results = {"silver": silver, "gold": run_gold_days(spark, plan, paths, runs) if several else run_gold(spark, plan, paths, run)}
    if paths.bi:
        results["bi_export"] = run_bi(spark, plan, paths, run)
    steps: dict[str, Any] = {step: result.summary() for step, result in results.items()}
    if audit_root:
        for result in results.values():
            append_audit(quality_audit(spark, result), f"{audit_root}/quality")
        partitions = [run_partition_summary(spark, plan.gold_spec(paths.gold), own, results["gold"].name) for own in (runs if several else [run])]
        append_audit(functools.reduce(DataFrame.unionByName, partitions), f"{audit_root}/partitions")
    if paths.table:
        steps["catalog"] = {"table": paths.table, "row_count": catalog.row_count(spark, paths.table).first()["row_count"]}
    told = {"business_dates": [own.business_date.isoformat() for own in runs]} if several else {}
    return {"pipeline": plan.name, "run_id": run.run_id, "business_date": run.business_date.isoformat(), **told, **steps}


def run_chain(
    spark: SparkSession,
    plan: MedallionPlan,
    paths: MedallionPaths,
    run: RunContext,
    *,
    audit_root: str | None = None,
) -> dict[str, Any]:
    """E3: silver, gold, the snapshot (when a BI target is given) and the catalog count (when a table is), in order.

    Without a source file in ``run`` each row keeps the name of its own
    landing file. With ``audit_root``, every step's rule counts and the gold
    rows per partition are appended to audit tables there (E5).
    """
    return _after_silver(spark, plan, paths, run, run_silver(spark, plan, paths, run), audit_root)


def backfill(
    spark: SparkSession,
    plan: MedallionPlan,
    paths: MedallionPaths,
    business_date: str | dt.date | None = None,
    *,
    run_id: str | None = None,
    processed_at_utc: str | None = None,
    source_file: str | None = None,
    arrival: Arrival | None = None,
) -> dict[str, Any]:
    """E4: re-run the chain for an existing landing file and an explicit business date.

    Silver is replaced by that file; in gold only that date's folder changes.
    An ``arrival`` gives the landing file, the date and the run id at once.
    """
    if arrival is not None:
        paths = replace(paths, landing=arrival.source_uri)
        run = arrival.run(processed_at_utc)
    else:
        run = RunContext.create(business_date, run_id=run_id, processed_at_utc=processed_at_utc, source_file=source_file)
    return run_chain(spark, plan, paths, run)


def run_partition_summary(spark: SparkSession, spec: TableSpec, run: RunContext, name: str) -> DataFrame:
    """E5: rows per partition that this run wrote to a partitioned target.

    Rows carry their ``run_id``, so the count reads just that column and the
    partition columns (taken from the folder names).
    """
    target = read_published(spark, spec)
    parts = list(spec.partition_by)
    if spec.check_run_date:
        # A one-day run wrote only its own folder: prune to it.
        for part, value in run.partition_values.items():
            if part in parts:
                target = target.where(F.col(part) == F.lit(value))
    return (
        target.where(F.col("run_id") == F.lit(run.run_id))
        .groupBy(*parts)
        .agg(F.count(F.lit(1)).alias("rows_written"))
        .select(
            F.lit(name).alias("pipeline"),
            F.lit(run.run_id).alias("run_id"),
            *parts,
            "rows_written",
        )
    )


def quality_audit(spark: SparkSession, result: JobResult) -> DataFrame:
    """E5: violations per rule for one run (one row per rule of the contract)."""
    rows = [
        (result.name, result.run_id, int(r["rule_order"]), r["rule"], r["column_name"], int(r["violations"]))
        for r in result.report
    ]
    return spark.createDataFrame(
        rows, "pipeline string, run_id string, rule_order int, rule string, column_name string, violations bigint"
    )


AUDIT_KEY = ["run_id", "pipeline"]
COMPACT_AFTER = 64  # folders of single runs before they are merged


def append_audit(df: DataFrame, path: str, compact_after: int = COMPACT_AFTER) -> None:
    """Add audit rows (small: one per partition or per rule) to a Parquet table, which :func:`read_audit` reads.

    A write replaces only the folder of its own run and step, so a
    replayed run (a re-delivered micro-batch, a retry) does not duplicate its
    rows. Every ``compact_after`` run folders are merged (:func:`compact_audit`).
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*AUDIT_KEY)
        .parquet(path)
    )
    if len(_run_folders(df.sparkSession, path)) >= compact_after:
        compact_audit(df.sparkSession, path, df.schema)


def _run_folders(spark: SparkSession, path: str) -> list[str]:
    return [p for p, is_dir in S.list_dir(spark, path) if is_dir and p.rsplit("/", 1)[-1].startswith(f"{AUDIT_KEY[0]}=")]


def read_audit(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """E5: the audit rows of every run; a run folder stands for the merged rows of its run and step.

    Run folders are listed before the merged state is looked up. Rows that a
    merge moves meanwhile are thus found twice, not missed, and the folder's are taken.
    """
    recent = _recent(spark, path, schema)
    return _with_merged(spark, path, schema, recent)


def _recent(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not _run_folders(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path).select(*schema.names)


def _with_merged(spark: SparkSession, path: str, schema: T.StructType, recent: DataFrame) -> DataFrame:
    merged = versions.current_locations(spark, path)
    if not merged:
        return recent
    old = spark.read.schema(schema).parquet(*merged)
    return old.join(recent.select(*AUDIT_KEY).distinct(), AUDIT_KEY, "left_anti").select(*schema.names).unionByName(recent)


def compact_audit(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """E5: merge the folders of single runs into one version of the table; False if another merge is at work.

    Only the files that were merged are deleted, after the version that holds
    them is visible: a merge that dies, or a run that is replayed meanwhile,
    leaves run folders, which replace their merged rows. The version
    before stays for its readers until the next merge, so the table has
    the run folders since the last one and the files of two versions.
    """
    lock = f"{path.rstrip('/')}/{versions.FOLDER}/merging"
    if not S.create_new(spark, lock):
        age = S.age_seconds(spark, lock)
        if age is not None and age > versions.CLAIM_SECONDS:
            S.delete_path(spark, lock)  # its owner died; the next append merges
        return False
    try:
        folders = _run_folders(spark, path)
        recent = _recent(spark, path, schema)
        files = [unquote(p) for p in recent.inputFiles()]  # of the runs since the last merge; deleted below
        versions.vacuum(spark, path)
        version = uuid.uuid4().hex
        rows = _with_merged(spark, path, schema, recent).hint("rebalance")
        rows.write.parquet(versions.data_path(path, version))
        versions.publish(spark, path, version, replace_all=True)
        S.delete_all(spark, files)
        for folder in folders:
            S.delete_if_empty(spark, folder)
    finally:
        S.delete_path(spark, lock)
    return True


def arrival_handler(
    plan: MedallionPlan,
    silver: str,
    gold: str,
    bi: str | None = None,
    *,
    bronze_columns: list[str] | None = None,
    audit_root: str | None = None,
    table: str | None = None,
) -> Callable[[DataFrame, RunContext], dict[str, Any] | None]:
    """E1 + E3: a ``streaming.ingest`` handler that runs the whole chain for each batch of landed files.

    The business date is the one given to the ingest, or else each file's
    arrival date: a batch of several days has a run for each of them, with a run id derived
    from the batch's, and every day's rows carry their own run. Silver
    is replaced by the whole batch, gold's days are written together, each replacing
    its folder only, and the snapshot is of the last day. Each row's source
    file is its own. A batch without data rows is logged and leaves every
    table as it was.
    """

    def handle(batch: DataFrame, run: RunContext) -> dict[str, Any] | None:
        spark = batch.sparkSession
        # One row for each arrival date, not for each file or row.
        dates = [r["business_date"] for r in batch.select("business_date").distinct().orderBy("business_date").collect()]
        if not dates:
            log.warning("Run %s: the landed files hold no rows; tables left untouched.", run.run_id)
            return None
        runs = {dates[0]: run} if run.date_given else runs_of_dates(run, dates)
        arrival_columns = ("source_uri", "bucket_name", "object_key", "event_time", "business_date")
        bronze = batch.withColumnRenamed("source_filename", TF.SOURCE_COLUMN)
        kept = [*bronze_columns, TF.SOURCE_COLUMN] if bronze_columns else [c for c in bronze.columns if c not in arrival_columns]
        days = []
        for date, own in runs.items():
            # A condition on file times: a day's scan opens that day's files only.
            of_day = bronze if len(runs) == 1 else bronze.where(F.col("business_date") == F.lit(date))
            days.append(plan.to_silver(of_day.select(*kept), own))
        spec = plan.silver_spec(silver)
        if len(runs) > 1:
            spec = replace(spec, check_run_date=False)
        published = publish(functools.reduce(DataFrame.unionByName, days), spec, run, name=f"{plan.name}_silver")
        paths = MedallionPaths(landing="", silver=silver, gold=gold, bi=bi, table=table)
        return _after_silver(spark, plan, paths, list(runs.values())[-1], published, audit_root, list(runs.values()))

    return handle


def runs_of_dates(run: RunContext, dates: Sequence[dt.date]) -> dict[dt.date, RunContext]:
    """A run for each date; the only one keeps the run's id, several have ids derived from it (the same on a replay)."""
    if len(dates) == 1:
        return {dates[0]: replace(run, business_date=dates[0])}
    return {d: replace(run, business_date=d, run_id=uuid.uuid5(uuid.NAMESPACE_URL, f"{run.run_id}/{d.isoformat()}").hex) for d in dates}
