"""Table jobs: transform -> contract gate -> publish -> read-back.

A job never publishes a result that failed its contract. How a table is gated
is a property of its spec, whatever the size of a run:

``cache`` (the default)
    The result is persisted (memory, spilling to disk), every rule runs over
    it in two actions (scalar rules, then the key-only shuffle), and the write
    reuses the cached rows. The source is read once. If an executor is lost,
    its cached blocks are recomputed from the plan.

``observe``
    For tables larger than the cluster's memory and disks: the result is
    written once, as a new version of the table
    (:mod:`terrace.sinks.versions`), while ``DataFrame.observe`` collects the
    scalar rule counts; the key rule then reads only the key columns of what
    was written. The version becomes visible when every rule passed, by one
    small file; no data is moved, and readers
    (:func:`terrace.sources.read_current`) see the old rows or the new ones.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace import catalog, sinks, sources
from terrace import functions as TF
from terrace import session as S
from terrace.contract import Contract
from terrace.operators import quality as Q
from terrace.run import RunContext

Transform = Callable[[DataFrame, RunContext], DataFrame]

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class TableSpec:
    """Where and how one table is published."""

    contract: Contract
    path: str
    fmt: str = "parquet"
    layout: str = "dataset"  # dataset | file (one file, joined from all tasks' parts)
    write_mode: str = "overwrite_full"  # overwrite_full | overwrite_partition
    partition_by: tuple[str, ...] = ()
    partition_style: str = "hive"  # hive | numeric
    compression: str | None = "snappy"
    check_run_date: bool = True
    gate: str = "cache"  # cache | observe
    max_records_per_file: int | None = None
    rebalance: bool = False
    catalog_table: str | None = None  # register/refresh this external table after publishing
    staged: bool = True  # full overwrites swap in a staged copy (False on object stores)
    readback: str = "rows"  # rows (counted, from footers) | content (rows and the sum of their hashes, one full read)

    def __post_init__(self):
        if self.layout not in ("dataset", "file"):
            raise ValueError(f"Unsupported layout '{self.layout}'.")
        if self.write_mode not in ("overwrite_full", "overwrite_partition"):
            raise ValueError(f"Unsupported write mode '{self.write_mode}'.")
        if self.layout == "file" and self.partition_by:
            raise ValueError("A single-file target cannot be partitioned.")
        if self.write_mode == "overwrite_partition" and not self.partition_by:
            raise ValueError("overwrite_partition needs partition columns.")
        if self.gate not in ("cache", "observe"):
            raise ValueError(f"Unsupported gate '{self.gate}'.")
        if self.readback not in ("rows", "content"):
            raise ValueError(f"Unsupported read-back '{self.readback}'.")
        if self.gate == "observe" and self.readback != "rows":
            raise ValueError("The observe gate checks rows in the files themselves; it has no earlier copy to compare.")
        if self.gate == "observe" and (self.layout, self.fmt, self.partition_style) != ("dataset", "parquet", "hive"):
            raise ValueError("The observe gate writes versions of a Parquet dataset.")


@dataclass
class JobResult:
    name: str
    target: str
    columns: list[str]
    rows: int
    run_id: str
    business_date: str
    partition_by: list[str]
    report: list[dict[str, Any]] = field(default_factory=list)

    def summary(self) -> dict[str, Any]:
        return {
            "pipeline": self.name,
            "target_uri": self.target,
            "columns": self.columns,
            "rows": self.rows,
            "run_id": self.run_id,
            "business_date": self.business_date,
            "partition_by": self.partition_by,
        }


def publish(
    df: DataFrame,
    spec: TableSpec,
    run: RunContext,
    *,
    name: str | None = None,
    inputs: Iterable[str] = (),
) -> JobResult:
    """Gate ``df`` against ``spec.contract`` and write it to ``spec.path``.

    ``inputs`` adds to the folders that the plan itself reads.
    """
    spark = df.sparkSession
    sinks.guard_not_input(spark, [*inputs, *S.relation_paths(df)], spec.path)
    Q.check_columns(df, spec.contract)
    Q.check_types(df, spec.contract)
    quality_run = run if spec.check_run_date else None
    if spec.gate == "observe":
        gate = _publish_observed(df, spec, quality_run)
    else:
        cached = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            gate = Q.enforce(cached, spec.contract, quality_run)
            if gate.rows == 0:
                raise sinks.EmptyResultError(f"Nothing to write to {spec.path}: the result is empty.")
            _write(cached, spec, run, gate.rows)
        finally:
            cached.unpersist()
    if spec.catalog_table:
        _register(spark, spec, run)
    log.info("Run %s published %d rows to %s (%s)", run.run_id, gate.rows, spec.path, spec.contract.name)
    return JobResult(
        name=name or spec.contract.name,
        target=spec.path,
        columns=list(df.columns),
        rows=gate.rows,
        run_id=run.run_id,
        business_date=run.business_date.isoformat(),
        partition_by=list(spec.partition_by),
        report=gate.report,
    )


def read_published(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """The table as its spec publishes it, with the contract's types and column order."""
    if spec.gate == "observe":
        return sources.read_current(spark, spec.path, spec.contract.schema, spec.partition_by)
    if spec.partition_style == "numeric" and spec.partition_by:
        return sources.read_numeric_partitions(spark, spec.path, spec.partition_by).select(*spec.contract.names)
    if spec.fmt == "csv":
        return spark.read.schema(spec.contract.schema).options(**sinks.CSV_OPTIONS).csv(spec.path)
    if spec.layout == "file":
        return spark.read.schema(spec.contract.schema).parquet(spec.path)
    return sources.read_table(spark, spec.path, spec.contract.schema, spec.fmt)


def _one_day(spec: TableSpec) -> bool:
    """The run's own partition is all that a job of this spec writes."""
    return bool(spec.partition_by) and spec.write_mode == "overwrite_partition" and spec.check_run_date


def _numeric(spec: TableSpec) -> bool:
    return bool(spec.partition_by) and spec.partition_style == "numeric"


def _write(df: DataFrame, spec: TableSpec, run: RunContext, rows: int) -> None:
    """Write the checked rows and read them back, before a staged copy or a new version replaces the table."""
    if _numeric(spec):
        _publish_numeric(df, spec, run, rows)
        return
    if spec.layout == "dataset" and spec.write_mode == "overwrite_full":
        sinks.overwrite_full(
            df, spec.path, fmt=spec.fmt, partition_by=spec.partition_by, compression=spec.compression, staged=spec.staged,
            max_records_per_file=spec.max_records_per_file, rebalance=spec.rebalance,
            check=lambda place: _verify_written(df, replace(spec, path=place), run, rows),
        )
        return
    _write_in_place(df, spec, run)
    _verify_written(df, spec, run, rows)


def _write_in_place(df: DataFrame, spec: TableSpec, run: RunContext) -> None:
    if spec.layout == "file":
        sinks.write_single_file(df, spec.path, fmt=spec.fmt, compression=spec.compression)
        return
    sinks.overwrite_partitions(
        df, spec.path, spec.partition_by, fmt=spec.fmt, compression=spec.compression,
        max_records_per_file=spec.max_records_per_file, rebalance=spec.rebalance,
    )


def _publish_numeric(df: DataFrame, spec: TableSpec, run: RunContext, rows: int) -> None:
    """K8: data is written once, as a version, and a manifest names the numeric folders' places; nothing is moved or deleted.

    The one day of a run goes below its own folder (``root/2026/4/3``), many
    days go to the version's folders in one partitioned write.
    """
    spark, parts, version = df.sparkSession, list(spec.partition_by), uuid.uuid4().hex
    if _one_day(spec):
        day = sinks.partition_location(spec.path, run.partition_values, parts, "numeric")
        place = f"{day}/version={version}"
        name = sinks.partition_location("", run.partition_values, parts, "numeric").strip("/")
    else:
        place = sinks.versions.data_path(spec.path, version)
    try:
        frame, split = (df.drop(*parts), ()) if _one_day(spec) else (df, parts)
        sinks.overwrite_full(frame, place, partition_by=split, compression=spec.compression, max_records_per_file=spec.max_records_per_file, rebalance=True, staged=False)
        if spec.readback == "content":
            back = spark.read.schema(frame.schema).option("basePath", place).parquet(place)
            _verify_content(frame, back, list(split), place)
        if split:
            if spec.readback == "rows":
                expected = df.groupBy(*parts).agg(F.count(F.lit(1)).alias("rows_written"))
                sinks.verify_partitions(expected, sinks.readback_counts(spark, place, parts), parts, place)
            new = sinks.versions.numeric(sinks.versions.written(spark, spec.path, version, parts))
        else:
            found = sinks.readback_counts(spark, place).first()["rows_read"]
            if found != rows:
                raise sinks.ReadBackError(f"{place}: {rows} written, {found} found.")
            new = spark.createDataFrame([(name, S.qualified(spark, place))], sinks.versions.SCHEMA)
    except Exception:
        S.delete_path(spark, place)
        raise
    sinks.versions.publish(spark, spec.path, version, parts, replace_all=spec.write_mode == "overwrite_full", new=new)


def _publish_observed(df: DataFrame, spec: TableSpec, quality_run: RunContext | None) -> Q.GateResult:
    spark = df.sparkSession
    observed, observation, rules = Q.observe(df, spec.contract, quality_run)
    version = uuid.uuid4().hex
    place = sinks.versions.data_path(spec.path, version)
    try:
        sinks.overwrite_full(
            observed, place, partition_by=spec.partition_by, compression=spec.compression,
            max_records_per_file=spec.max_records_per_file, rebalance=spec.rebalance, staged=False,
        )
        # Rows are counted in the files: a stage that ran twice may be observed twice.
        rows = sinks.readback_counts(spark, place, schema=spec.contract.schema).first()["rows_read"]
        if rows == 0:
            raise sinks.EmptyResultError(f"Nothing to write to {spec.path}: the result is empty.")
        key_violations = 0
        if spec.contract.primary_key:
            keys = spark.read.schema(spec.contract.schema).option("basePath", place).parquet(place)
            key_violations = Q.duplicate_key_groups(keys, spec.contract.primary_key).first()["violations"]
        gate = Q.evaluate(Q.observed_report(observation, rules, key_violations), rules)
    except Exception:
        S.delete_path(spark, place)
        raise
    sinks.versions.publish(spark, spec.path, version, spec.partition_by, replace_all=spec.write_mode == "overwrite_full")
    gate.rows = int(rows)
    return gate


def _register(spark: SparkSession, spec: TableSpec, run: RunContext) -> None:
    """C1/C2 after a publish: create the external table once, then make the new data visible.

    Tables published with a manifest have the difference to the manifest that the
    catalog last knew registered. Otherwise a one-day run registers just its
    own partition, and a write of many days has the catalog compare its
    partitions with the folders.
    """
    table = spec.catalog_table
    if not spark.catalog.tableExists(table):
        if "." in table:
            catalog.ensure_database(spark, table.rsplit(".", 1)[0])
        catalog.register_external_table(spark, table, spec.contract, spec.path, fmt=spec.fmt, partitioned=bool(spec.partition_by), replace=False)
    parts = list(spec.partition_by)
    if parts and (spec.gate == "observe" or _numeric(spec)):
        known, number = catalog.synced_manifest(spark, table), sinks.versions.latest(spark, spec.path)
        previous = sinks.versions.manifest(spark, spec.path, known) if known else None
        current = sinks.versions.manifest(spark, spec.path, number)
        catalog.sync_partitions(spark, table, spec.contract, parts, current, number, previous)
    elif parts and _one_day(spec):
        catalog.add_partition(spark, table, {k: run.partition_values[k] for k in parts})
    elif parts:
        catalog.repair(spark, table)
    spark.catalog.refreshTable(table)


def _verify_written(checked: DataFrame, spec: TableSpec, run: RunContext, rows: int) -> None:
    """K7: the target holds the rows that were checked, partition by partition where the run wrote several."""
    spark, parts = checked.sparkSession, list(spec.partition_by)
    if spec.readback == "content":
        target = read_published(spark, spec)
        if _one_day(spec):
            for part in parts:
                target = target.where(F.col(part) == F.lit(run.partition_values[part]))
        _verify_content(checked, target, parts, spec.path, spec.fmt)
        return
    if parts and not _one_day(spec):
        expected = checked.groupBy(*parts).agg(F.count(F.lit(1)).alias("rows_written"))
        found = read_published(spark, spec).groupBy(*parts).agg(F.count(F.lit(1)).alias("rows_read"))
        sinks.verify_partitions(expected, found, parts, spec.path)
        return
    location = spec.path
    if parts:
        location = sinks.partition_location(spec.path, run.partition_values, parts, spec.partition_style)
    if not S.path_exists(spark, location):
        raise sinks.ReadBackError(f"{location} is missing after {rows} rows were written.")
    found = sinks.readback_counts(spark, location, fmt=spec.fmt, schema=spec.contract.schema if spec.fmt == "csv" else None).first()["rows_read"]
    if found != rows:
        raise sinks.ReadBackError(f"{location}: {rows} written, {found} found.")


def _verify_content(checked: DataFrame, written: DataFrame, parts: list[str], place: str, fmt: str = "parquet") -> None:
    expected = sinks.content_sums(checked, parts, fmt).withColumnRenamed("rows", "rows_written")
    sinks.verify_partitions(expected, sinks.content_sums(written, parts, fmt).withColumnRenamed("rows", "rows_read"), parts, place)


def run_table_job(
    spark: SparkSession,
    source: DataFrame,
    transform: Transform,
    spec: TableSpec,
    run: RunContext,
    *,
    name: str | None = None,
    inputs: Iterable[str] = (),
) -> JobResult:
    """A1/A2/A3: ``transform(source, run)`` gated and published to ``spec``."""
    return publish(transform(source, run), spec, run, name=name, inputs=inputs)


def sql_transform(text: str, source_name: str = "source") -> Transform:
    """A transform from SQL text that reads ``{source}`` and uses ``:name`` run parameters."""

    def apply(df: DataFrame, run: RunContext) -> DataFrame:
        used = {k: v for k, v in run.sql_args().items() if f":{k}" in text}
        if TF.SOURCE_COLUMN in text and TF.SOURCE_COLUMN not in df.columns:
            df = df.withColumn(TF.SOURCE_COLUMN, F.lit(None).cast("string"))
        return df.sparkSession.sql(text, args=used, **{source_name: df})

    return apply
