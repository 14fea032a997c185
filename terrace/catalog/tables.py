"""Catalog: external tables over published folders, partition registration,
date-range views and the post-load row count.

Tables are declared from the contract's schema (never inferred). Partitioned
tables list their partition columns last, as catalogs show them. New
partitions become visible by registering the run's folder
(``ADD PARTITION``), which touches one folder; ``repair`` rescans the whole
location and is meant for bulk loads.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.contract import Contract


def _text(value: object) -> str:
    """An SQL string literal."""
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _quote(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _ddl_columns(contract: Contract) -> str:
    ordered = contract.with_partitions_last() if contract.partition_columns else contract
    return ", ".join(f"{_quote(f.name)} {f.dataType.simpleString()}" for f in ordered.schema.fields)


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    clause = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quote(database)}{clause}")


def register_external_table(
    spark: SparkSession,
    table: str,
    contract: Contract,
    location: str,
    *,
    fmt: str = "parquet",
    partitioned: bool = True,
    replace: bool = True,
) -> str:
    """C1/C2: an external table at ``location`` with the contract's declared columns."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {_quote(table)}")
    partition_clause = ""
    if partitioned and contract.partition_columns:
        partition_clause = " PARTITIONED BY (" + ", ".join(f"{_quote(p)}" for p in contract.partition_columns) + ")"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quote(table)} ({_ddl_columns(contract)}) "
        f"USING {fmt}{partition_clause} LOCATION {_text(location)}"
    )
    return table


def _partition(values: Mapping[str, int | str]) -> str:
    return "PARTITION (" + ", ".join(f"{_quote(k)} = {v if isinstance(v, int) else _text(v)}" for k, v in values.items()) + ")"


def add_partition(spark: SparkSession, table: str, values: Mapping[str, int | str], location: str | None = None) -> None:
    """Register one written partition (the run's business date), at ``location`` if that isn't the Hive-style folder."""
    add_partitions(spark, table, [(values, location)])


def add_partitions(spark: SparkSession, table: str, partitions: Iterable[tuple[Mapping[str, int | str], str | None]]) -> None:
    """Register several partitions that the catalog doesn't have yet, in one statement."""
    partitions = list(partitions)
    if partitions:
        added = " ".join(_partition(v) + (f" LOCATION {_text(at)}" if at else "") for v, at in partitions)
        spark.sql(f"ALTER TABLE {_quote(table)} ADD IF NOT EXISTS {added}")


def drop_partitions(spark: SparkSession, table: str, partitions: Iterable[Mapping[str, int | str]]) -> None:
    """Take several partitions out of the catalog, in one statement; the files of an external table stay."""
    dropped = ", ".join(_partition(v) for v in partitions)
    if dropped:
        spark.sql(f"ALTER TABLE {_quote(table)} DROP IF EXISTS {dropped}")


STATEMENT_PARTITIONS = 200
SYNCED = "terrace.manifest"  # table property: the manifest that the registered partitions are


def synced_manifest(spark: SparkSession, table: str) -> int:
    """Number of the manifest that the table was last made equal to, 0 if none."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quote(table)}").collect()}
    return int(found.get(SYNCED, 0))


def registered(spark: SparkSession, table: str) -> DataFrame:
    """partition (values, ``/`` between them) of each registered partition, with an unknown location."""
    shown = spark.sql(f"SHOW PARTITIONS {_quote(table)}")
    return shown.select(F.regexp_replace("partition", r"(^|/)[^/=]+=", "$1").alias("partition"), F.lit("").alias("location"))


def sync_partitions(
    spark: SparkSession,
    table: str,
    contract: Contract,
    partition_by: Iterable[str],
    current: DataFrame,
    number: int,
    previous: DataFrame | None = None,
    *,
    batch: int = STATEMENT_PARTITIONS,
) -> int:
    """Make the registered partitions equal to manifest ``number``; returns the number of statements.

    ``current`` and ``previous`` (the manifest that the table was last made
    equal to; without it, what is registered) have partition values and
    location. Their difference is a join; only its rows reach the driver, a
    statement's worth at a time, so unchanged partitions cost nothing.
    """
    parts = list(partition_by)
    plain = F.regexp_replace("partition", r"(^|/)[^/=]+=", "$1")
    before = registered(spark, table) if previous is None else previous.select(plain.alias("partition"), "location")
    joined = current.select(plain.alias("partition"), F.col("location").alias("now")).join(before.withColumnRenamed("location", "old"), "partition", "full_outer")
    changed = joined.where(~F.col("now").eqNullSafe(F.col("old")))
    whole = [isinstance(contract.column(p).data_type, T.IntegralType) for p in parts]
    rows, statements = changed.toLocalIterator(), 0
    while chunk := list(itertools.islice(rows, batch)):
        values = [{p: int(v) if i else unquote(v) for p, i, v in zip(parts, whole, r["partition"].split("/"))} for r in chunk]
        gone = [v for v, r in zip(values, chunk) if r["old"] is not None]
        new = [(v, r["now"]) for v, r in zip(values, chunk) if r["now"] is not None]
        drop_partitions(spark, table, gone)
        add_partitions(spark, table, new)
        statements += bool(gone) + bool(new)
    spark.sql(f"ALTER TABLE {_quote(table)} SET TBLPROPERTIES ({_text(SYNCED)} = {_text(number)})")
    return statements


def repair(spark: SparkSession, table: str) -> None:
    """Make the registered partitions equal to the folders under the table's location: new ones are added, lost ones dropped."""
    spark.sql(f"MSCK REPAIR TABLE {_quote(table)} SYNC PARTITIONS")


def projected_view(
    spark: SparkSession,
    view: str,
    table: str,
    ranges: Mapping[str, tuple[int, int]],
) -> DataFrame:
    """C2 projection bounds: a view that only exposes partitions inside the ranges.

    The bounds are partition filters, so folders outside them are never
    listed into a scan.
    """
    cond = F.lit(True)
    for column, (low, high) in ranges.items():
        cond = cond & F.col(column).between(low, high)
    df = spark.table(table).where(cond)
    df.createOrReplaceTempView(view)
    return df


def row_count(spark: SparkSession, table: str) -> DataFrame:
    """C3: ``SELECT COUNT(*) AS row_count`` over a catalog table."""
    return spark.table(table).agg(F.count(F.lit(1)).alias("row_count"))
