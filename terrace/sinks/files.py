"""File sinks: full and per-partition overwrite, single-file snapshots,
CSV datasets, numeric partition folders and the post-write read-back.

Overwrite behaviour is set on each write (``partitionOverwriteMode``), never
on the session, so one job's dynamic write cannot turn another job's full
overwrite into a partial one.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace import session as S
from terrace.sinks import row_groups

# CSV text format of the snapshot (naive UTC timestamps with
# whole seconds, ISO dates, quotes escaped by doubling).
CSV_OPTIONS = {
    "header": "true",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "dateFormat": "yyyy-MM-dd",
    "escape": '"',
    "quote": '"',
}


class EmptyResultError(RuntimeError):
    """The run produced no rows; the target is left as it was."""


class SelfOverwriteError(RuntimeError):
    """The target is also an input of the plan being written."""


def guard_not_input(spark: SparkSession, source_paths: Iterable[str], target: str) -> None:
    """Refuse to write a target that is (inside) one of the job's inputs, or vice versa.

    Overwriting the folder a plan reads deletes its input before the read
    finishes. Paths are compared with their scheme and authority.
    """
    place = S.qualified(spark, target) + "/"
    for source in {str(p) for p in source_paths}:
        other = S.qualified(spark, source.split("*", 1)[0] if "*" in source else source) + "/"
        if other.startswith(place) or ("*" not in source and place.startswith(other)):
            raise SelfOverwriteError(f"Target {target} overlaps input {source}.")


def _writer(df: DataFrame, fmt: str, compression: str | None, max_records_per_file: int | None, overwrite: str):
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    if compression and fmt == "parquet":
        writer = writer.option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    return writer


def overwrite_full(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    partition_by: Iterable[str] = (),
    compression: str | None = "snappy",
    max_records_per_file: int | None = None,
    rebalance: bool = False,
    staged: bool = True,
    check: Callable[[str], None] | None = None,
) -> str:
    """K1/K2/K6: replace the whole target; stale partitions disappear.

    ``rebalance`` hash-distributes rows by the partition columns before the
    write (AQE splits a hot partition and merges small ones), so each folder
    gets few files instead of one per task.

    ``staged`` (default) writes into a sibling folder and swaps it in after
    the job has committed, so a job that fails part-way (lost executors beyond
    the retry limit, a killed driver) leaves the previous table in place; a
    plain overwrite deletes the target when the job starts. On object stores,
    where a folder move is a copy, pass ``staged=False``. ``check`` is called
    with the written folder; what it raises keeps a staged copy from being
    swapped in.
    """
    parts = list(partition_by)
    if rebalance and parts:
        df = df.hint("rebalance", *parts)
    target = path
    if staged:
        parent, leaf = path.rstrip("/").rsplit("/", 1)
        target = f"{parent}/_{leaf}_stage_{uuid.uuid4().hex[:8]}"
    writer = _writer(df, fmt, compression, max_records_per_file, "static")
    if parts:
        writer = writer.partitionBy(*parts)
    spark = df.sparkSession
    try:
        writer.format(fmt).save(target)
        if check is not None:
            check(target)
    except Exception:
        if staged:
            S.delete_path(spark, target)
        raise
    if staged:
        S.delete_path(spark, path)
        S.rename_path(spark, target, path)
    return path


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partition_by: Iterable[str],
    *,
    fmt: str = "parquet",
    compression: str | None = "snappy",
    max_records_per_file: int | None = None,
    rebalance: bool = False,
    rows: int | None = None,
) -> str:
    """K3: replace only the partitions present in ``df``; others stay untouched.

    ``rows`` is the checked row count; zero rows is refused before the target
    is touched (an empty write would otherwise silently keep or drop the old
    day, depending on the engine).
    """
    if rows == 0:
        raise EmptyResultError(f"Nothing to write to {path}: the result is empty.")
    parts = list(partition_by)
    if not parts:
        raise ValueError("overwrite_partitions needs partition columns.")
    if rebalance:
        df = df.hint("rebalance", *parts)
    writer = _writer(df, fmt, compression, max_records_per_file, "dynamic").partitionBy(*parts)
    writer.format(fmt).save(path)
    return path


def write_single_file(df: DataFrame, target_file: str, *, fmt: str = "csv", compression: str | None = "snappy") -> str:
    """One file at a stable path (CSV with header, or Parquet), where a consumer can take no folder.

    All tasks write parts, in the order of the frame's partitions, and the parts are
    joined without passing through one process (:func:`terrace.session.concat`:
    tasks copy them to their places where the folder is mounted, HDFS links blocks).
    CSV parts have no header and follow one; Parquet parts stay whole and are
    followed by a footer that names the row groups of all.

    Other file systems join no files, and encrypted Parquet can't be joined: there
    one task writes the file. The plan before it runs at full parallelism
    (``repartition(1)``, not ``coalesce(1)``, which would pull the whole scan into
    that task). The file is moved over the target once it is complete.
    """
    spark = df.sparkSession
    parent, name = target_file.rstrip("/").rsplit("/", 1)
    stem = name.rsplit(".", 1)[0]
    stage = f"{parent}/_{stem}_stage_{uuid.uuid4().hex[:8]}"
    joined = S.can_concat(spark, parent) and (fmt == "csv" or fmt == "parquet" and not row_groups.encrypted(spark))
    try:
        writer = _writer(df if joined else df.repartition(1), fmt, compression, None, "static")
        (writer.option("header", "false") if joined else writer).format(fmt).save(stage)
        staged = sorted(S.data_files(spark, stage, fmt), key=_task_of)
        if joined and staged and (fmt == "csv" or len(staged) > 1):
            staged = [_joined(df, stage, staged, fmt)]
        if len(staged) != 1:
            raise FileNotFoundError(f"Expected one {fmt} part file under {stage}, found {len(staged)}.")
        S.delete_path(spark, target_file)
        S.rename_path(spark, staged[0], target_file)
    finally:
        S.delete_path(spark, stage)
    return target_file


def _task_of(part: str) -> tuple[int, str]:
    """Order of a part file: the number of the task that wrote it (``part-00007-...``)."""
    name = part.rsplit("/", 1)[-1]
    return int(name.split("-")[1]), name


def _joined(df: DataFrame, stage: str, parts: list[str], fmt: str) -> str:
    """The parts as one file of the staging folder: CSV behind a header line, Parquet before a common footer."""
    spark = df.sparkSession
    if fmt == "csv":
        place = f"{stage}/header_{uuid.uuid4().hex[:8]}"
        _writer(df.limit(0), fmt, None, None, "static").format(fmt).save(place)
        (header,) = S.data_files(spark, place, fmt)
        S.rename_path(spark, header, f"{stage}/header")
        files = [f"{stage}/header", *parts]
    else:
        row_groups.write_footer(spark, f"{stage}/footer", parts)
        files = [*parts, f"{stage}/footer"]
    S.concat(spark, f"{stage}/joined", files)
    return f"{stage}/joined"


# How a partition's value becomes a folder name, by layout.
SEGMENTS = {"hive": "{name}={value}".format, "numeric": "{value}".format}


def partition_location(root: str, values: Mapping[str, int | str], partition_by: Iterable[str], style: str = "hive") -> str:
    """K8: the folder of one partition, ``root/year=2026/month=4/day=3`` (hive) or ``root/2026/4/3`` (numeric)."""
    segment = SEGMENTS[style]
    return "/".join([root.rstrip("/"), *(segment(name=name, value=values[name]) for name in partition_by)])


def overwrite_numeric_partitions(
    df: DataFrame,
    root: str,
    partition_by: Iterable[str],
    *,
    compression: str | None = "snappy",
    rebalance: bool = True,
    rows: int | None = None,
) -> list[str]:
    """K8: write ``root/2026/4/3/`` folders (values only, no ``name=``).

    Spark writes a Hive layout into a staging folder next to the root; each
    staged leaf folder then replaces the matching numeric folder. Partitions
    not present in ``df`` are left alone. The partition values are not stored
    in the files; read them back from the path
    (:func:`terrace.sources.read_numeric_partitions`). For folders that
    consumers list themselves; jobs publish the layout by a manifest, without moves
    (``TableSpec(partition_style="numeric")``).
    """
    if rows == 0:
        raise EmptyResultError(f"Nothing to write to {root}: the result is empty.")
    spark = df.sparkSession
    parts = list(partition_by)
    stage = f"{root.rstrip('/')}_stage_{uuid.uuid4().hex[:8]}"
    overwrite_full(df, stage, partition_by=parts, compression=compression, rebalance=rebalance, staged=False)
    try:
        leaves = [stage]
        for _ in parts:
            leaves = [p for leaf in leaves for p, is_dir in S.list_dir(spark, leaf) if is_dir and "=" in p.rsplit("/", 1)[-1]]
        moves = []
        for leaf in sorted(leaves):
            values = dict(segment.split("=", 1) for segment in leaf.rstrip("/").split("/")[-len(parts) :])
            moves.append((leaf, partition_location(root, values, parts, "numeric")))
        S.move_all(spark, moves)
    finally:
        S.delete_path(spark, stage)
    return [target for _, target in moves]


def readback_counts(spark: SparkSession, path: str, partition_by: Iterable[str] = (), fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """K7: rows found in the target now, per partition (or in total).

    Only the partition columns are requested, so Parquet answers from file
    footers without reading column data.
    """
    parts = list(partition_by)
    reader = spark.read.option("basePath", path) if parts else spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    df = reader.format(fmt).load(path)
    if parts:
        return df.groupBy(*parts).agg(F.count(F.lit(1)).alias("rows_read"))
    return df.agg(F.count(F.lit(1)).alias("rows_read"))


class ReadBackError(RuntimeError):
    """A written target doesn't hold the rows that were checked."""


def _as_stored(field: T.StructField, fmt: str) -> Column:
    """The value as it comes back from a file: CSV keeps whole seconds, trims text and doesn't tell empty text from NULL."""
    value = F.col(field.name)
    if fmt != "csv":
        return value
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("second", value)
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(F.regexp_replace(value, r"^[\x00-\x20]+|[\x00-\x20]+$", ""), F.lit(""))
    return value


def content_sums(df: DataFrame, partition_by: Iterable[str] = (), fmt: str = "parquet") -> DataFrame:
    """K7: rows and the sum of their hashes, per partition (or in total): ``rows``, ``content``.

    The sum doesn't depend on the order of rows or files, and equal rows count
    as often as they occur. A row's hash takes its columns by name, so it also doesn't
    depend on where a layout puts the partition columns; those are left to
    the grouping. Partial sums are one row per partition and task.
    """
    parts = list(partition_by)
    fields = sorted((f for f in df.schema.fields if f.name not in parts), key=lambda f: f.name)
    # A NULL leaves a hash as it is, so which columns are NULL is hashed beside the values.
    nulls = F.concat(F.lit(""), *[F.when(_as_stored(f, fmt).isNull(), "1").otherwise("0") for f in fields])
    hashed = F.xxhash64(nulls, *[_as_stored(f, fmt) for f in fields])
    out = [F.count(F.lit(1)).alias("rows"), F.sum(hashed.cast("decimal(20,0)")).alias("content")]
    return df.groupBy(*parts).agg(*out) if parts else df.agg(*out)


def verify_partitions(expected: DataFrame, found: DataFrame, partition_by: Iterable[str], path: str) -> None:
    """K7: every partition of ``expected`` (parts, rows_written) is there with as many rows in ``found`` (parts, rows_read).

    With ``content`` columns (:func:`content_sums`) in both, these must agree as well.
    """
    parts = list(partition_by)
    content = "content" in expected.columns and "content" in found.columns
    if not parts:  # one row each
        e, f = expected.first(), found.first()
        same = e["rows_written"] == f["rows_read"] and (not content or e["content"] == f["content"])
        wrong = [] if same else [{**e.asDict(), **f.asDict()}]
    else:
        kept = [F.col("rows_read"), *([F.col("content").alias("__content")] if content else [])]
        right = found.select(*[F.col(p).alias(f"__{p}") for p in parts], *kept)
        same = functools.reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"__{p}")) for p in parts])
        differs = F.col("rows_written") != F.coalesce("rows_read", F.lit(0))
        if content:
            differs = differs | ~F.col("content").eqNullSafe(F.col("__content"))
        wrong = expected.join(right, same, "left").where(differs).orderBy(*parts).limit(5).collect()
    if wrong:
        raise ReadBackError(f"{path}: " + "; ".join(_difference(row, parts) for row in wrong) + ".")


def _difference(row: Mapping, parts: list[str]) -> str:
    place = {p: row[p] for p in parts} or "all rows"
    if row["rows_written"] == row["rows_read"]:
        return f"{place}: {row['rows_written']} rows, other values"
    return f"{place}: {row['rows_written']} written, {row['rows_read'] or 0} found"
