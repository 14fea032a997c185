"""File sources: landing CSV as text, Parquet datasets, partitioned layouts."""

from __future__ import annotations

import csv
import functools
import re
import uuid
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace import session as S
from terrace.functions.columns import SOURCE_COLUMN
from terrace.sinks import versions

# Timestamp text layout of landing files written here (microseconds kept).
LANDING_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in columns])


def read_csv_strings(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    *,
    glob: str | None = None,
    with_file_name: bool = False,
    multiline: bool = False,
    malformed: str | None = None,
) -> DataFrame:
    """S1: CSV with a header row, every column read as text and bound by its header name.

    Files may order their columns differently and have further ones: each
    distinct header is one read, and the asked ``columns`` are taken by name
    (all of the first file's without ``columns``). A file whose header lacks
    one of them is an error that names the file. The headers are found by a
    Spark job over the files' lines (:func:`files_by_header`).

    Quotes inside a quoted field are doubled (RFC 4180, as spreadsheet and
    database exports write them); a backslash is an ordinary character.
    A row with more or fewer cells than its header stops the read with
    ``malformed_row`` and the file's name, or is kept with its text in the
    column ``malformed`` names (NULL for sound rows).
    ``with_file_name`` adds ``_source_file`` from the file metadata.
    ``multiline`` accepts line breaks inside quoted fields; each file is then
    parsed by one task (it cannot be split), so it is off by default.
    """
    places = [path] if isinstance(path, str) else list(path)
    files = [f for place in places for f in S.matching_files(spark, place, glob)]
    if not files:
        raise FileNotFoundError(f"No landing file matches {', '.join(places)}.")
    by_header = files_by_header(text_lines(spark.read.text(files)))
    seen = {_plain(f) for named in by_header.values() for f in named}
    blank = [f for f in files if _plain(f) not in seen]  # without a first line
    if blank:
        by_header.setdefault((), []).extend(blank)
    extra = {SOURCE_COLUMN: F.col("_metadata.file_name")} if with_file_name else {}
    return read_by_header(spark, by_header, columns, extra=extra, multiline=multiline, malformed=malformed)


def text_lines(text: DataFrame) -> DataFrame:
    """Lines of a text source with their ``file`` and the byte ``at`` which their block of it begins."""
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))


def first_lines(lines: DataFrame) -> DataFrame:
    """The first line of each ``file``: the first row of its first block, kept by the task that reads it."""
    heads = lines.where("at = 0").select("file", "value", F.monotonically_increasing_id().alias("place"))
    return heads.groupBy("file").agg(F.min_by("value", "place").alias("line"))


def files_by_header(lines: DataFrame) -> dict[tuple[str, ...], list[str]]:
    """File names by header. The first lines are found in a Spark job; the driver gets names and distinct headers, and opens no file."""
    groups = first_lines(lines).groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    out: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(groups, key=lambda r: r["files"][0]):
        header = tuple(next(csv.reader([row["line"].removeprefix("\ufeff")]), []))
        out.setdefault(header, []).extend(unquote(f) for f in row["files"])
    return out


def _plain(file: str) -> str:
    """A file's name in one spelling: ``file:///a`` is ``file:/a``."""
    return re.sub(r"^(\w[\w+.-]*):///", r"\1:/", file)


def read_by_header(
    spark: SparkSession,
    by_header: Mapping[tuple[str, ...], list[str]],
    columns: list[str] | None = None,
    *,
    extra: Mapping[str, Column] | None = None,
    multiline: bool = False,
    malformed: str | None = None,
) -> DataFrame:
    """S1/E1: CSV files grouped by their headers, as one frame of the asked columns, bound by name.

    ``extra`` adds columns computed from the rows' file metadata.
    """
    wanted = list(columns) if columns is not None else list(next(iter(by_header)))
    parts = []
    for header, named in by_header.items():
        lost = [c for c in wanted if c not in header]
        if lost:
            raise ValueError(f"The header of {named[0]} lacks the column(s) {', '.join(lost)}.")
        parts.append(_read_with_header(spark, named, list(header), wanted, extra or {}, multiline, malformed))
    return functools.reduce(DataFrame.unionByName, parts)


_BAD_ROW = "_malformed_row"


def malformed_schema(header: list[str]) -> T.StructType:
    return T.StructType([*string_schema(header), T.StructField(_BAD_ROW, T.StringType(), True)])


def sound_rows(rows: DataFrame, header: list[str]) -> DataFrame:
    """``rows`` (read with :func:`malformed_schema`), failing at one with more or fewer cells than the header."""
    # The message names a cell too: a read of no other column than the check's own isn't allowed.
    told = F.concat_ws(": ", F.concat(F.lit("malformed_row in "), F.col("_metadata.file_name")), F.col(f"`{header[0]}`"))
    return rows.where(F.assert_true(F.col(_BAD_ROW).isNull(), told).isNull())


def csv_options(multiline: bool = False) -> dict[str, str]:
    """How landing CSV is read, in batch and stream: doubled quotes, and rows of other widths kept for a check."""
    return {
        "header": "true",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _BAD_ROW,
        "columnPruning": "false",  # else surplus and missing cells go unseen
        "quote": '"',
        "escape": '"',
        "multiLine": str(multiline).lower(),
    }


def _read_with_header(spark, files, header, wanted, extra, multiline, malformed) -> DataFrame:
    rows = spark.read.schema(malformed_schema(header)).options(**csv_options(multiline)).option("enforceSchema", True).csv(files)
    if malformed is None:
        rows = sound_rows(rows, header)
    out = [F.col(f"`{c}`") for c in wanted]
    if malformed is not None:
        out.append(F.col(_BAD_ROW).alias(malformed))
    return rows.select(*out, *[value.alias(name) for name, value in extra.items()])


def resolve_landing_source(source: str, file_name: str | None) -> str:
    """S2: a prefix ending in ``/`` gets the file name (or glob) appended; a full URI is kept.

    A prefix without a file name means every matching file below it.
    """
    if source.endswith("/"):
        return f"{source}{file_name}" if file_name else source
    return source


def read_parquet(spark: SparkSession, path: str | list[str], *, recursive: bool = False) -> DataFrame:
    """S3: Parquet dataset; a folder without any Parquet file is an error."""
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    try:
        return reader.parquet(*(path if isinstance(path, list) else [path]))
    except AnalysisException as exc:
        if "UNABLE_TO_INFER_SCHEMA" in str(exc) or "PATH_NOT_FOUND" in str(exc):
            raise FileNotFoundError(f"{path} holds no Parquet data.") from exc
        raise


def read_partitioned(spark: SparkSession, root: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """S4: Hive-style ``k=v`` layout; partition columns come from the paths.

    Spark returns the partition columns last, typed by inference (plain
    integers become INT). Filters on them prune folders before any file is
    opened.
    """
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    try:
        return reader.format(fmt).load(root)
    except AnalysisException as exc:
        if "UNABLE_TO_INFER_SCHEMA" in str(exc) or "PATH_NOT_FOUND" in str(exc):
            raise FileNotFoundError(f"No {fmt} files were found under {root}.") from exc
        raise


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A published table read with its declared schema (contract types, partition columns included).

    Partition values are then typed by the contract instead of by inference, so
    a ``source_file=20240103`` folder stays a string. Columns come back in the
    declared order.
    """
    return spark.read.schema(schema).option("basePath", path).format(fmt).load(path).select(*schema.names)


def read_current(spark: SparkSession, root: str, schema: T.StructType, partition_by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The published state of a table written in versions (:mod:`terrace.sinks.versions`).

    Only the folders that the newest complete manifest lists are read.
    """
    places = versions.current_locations(spark, root)
    if not places:
        raise FileNotFoundError(f"{root} has no published version.")
    reader = spark.read.schema(schema).option("basePath", f"{root.rstrip('/')}/{versions.FOLDER}/data")
    return reader.parquet(*places).select(*schema.names)


def read_numeric_partitions(spark: SparkSession, root: str, partition_by: list[str] | tuple[str, ...], only: Mapping[str, int] | None = None) -> DataFrame:
    """K8 read side: ``root/2026/4/3`` with the values taken from the path.

    Where the layout was published with a manifest, only the folders that it
    lists are read. ``only`` names partition values; other folders aren't listed.
    """
    depth, places = len(partition_by), [root]
    live = versions.manifest(spark, root)
    if live is not None:
        for i, name in enumerate(partition_by):
            if only and name in only:
                live = live.where(F.split("partition", "/")[i] == F.lit(str(only[name])))
        places = sorted(r["location"] for r in live.collect())
        if not places:
            raise FileNotFoundError(f"{root} has no published folder for {dict(only or {})}.")
    df = spark.read.option("recursiveFileLookup", True).parquet(*places)
    # The folder of a version may have the partitions' names, or be inside the numeric folder.
    pattern = "/" + "/".join([r"(?:[^/=]+=)?(-?\d+)"] * depth) + r"(?:/version=[^/]+)?/[^/]+$"
    path = F.col("_metadata.file_path")
    df = df.withColumns({name: F.regexp_extract(path, pattern, i + 1).cast("int") for i, name in enumerate(partition_by)})
    for name, value in (only or {}).items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def sql_over(spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """S5 + P6: SQL over DataFrames bound by name (``{source}``) with typed ``:name`` parameters.

    Parameters are bound as literals, never spliced into the text, so no
    quoting is involved; a parameter the text uses but ``args`` lacks is an
    error raised by the analyzer.
    """
    return spark.sql(text, args=args or {}, **frames)


def land_files(
    df: DataFrame,
    prefix: str,
    stem: str,
    *,
    fmt: str = "csv",
    by: str | None = None,
) -> list[str]:
    """Write ``df`` as named files into a landing prefix.

    Spark writes the parts in parallel into a staging folder next to the
    prefix; each part is then moved (a metadata operation) to
    ``<prefix>/<stem>-<n>.<fmt>``, or ``<prefix>/<stem>_<value>-<n>.<fmt>``
    when ``by`` splits the files by the values of one column. Returns the
    landed paths.
    """
    spark = df.sparkSession
    parent = prefix.rstrip("/").rsplit("/", 1)[0]
    stage = f"{parent}/_landing_stage_{stem}_{uuid.uuid4().hex[:8]}"
    options = {}
    if fmt == "csv":
        options = {"header": True, "quote": '"', "escape": '"', "timestampFormat": LANDING_TIMESTAMP_FORMAT, "timestampNTZFormat": LANDING_TIMESTAMP_FORMAT}
    writer = df.write.mode("overwrite").options(**options)
    if by:
        writer = df.hint("rebalance", by).write.mode("overwrite").options(**options).partitionBy(by)
    writer.format(fmt).save(stage)
    moves: list[tuple[str, str]] = []
    counters: dict[str, int] = {}
    extension = {"text": "txt"}.get(fmt, fmt)
    for part in S.data_files(spark, stage, extension):
        tag = stem
        if by:
            value = part.rsplit("/", 2)[-2].split("=", 1)[1]
            tag = f"{stem}_{value}"
        n = counters.get(tag, 0)
        counters[tag] = n + 1
        moves.append((part, f"{prefix.rstrip('/')}/{tag}-{n:05d}.{extension}"))
    S.move_all(spark, moves)
    S.delete_path(spark, stage)
    return [target for _, target in moves]
