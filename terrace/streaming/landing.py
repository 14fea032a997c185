"""Landing-folder ingest with Structured Streaming.

Each new file matching the glob in the landing folder is one arrival. The file
source keeps the list of files already seen in the checkpoint, so a restart
(or a lost driver) resumes where it stopped and never reprocesses a file;
non-matching files (``.txt``, partial uploads with another suffix) are
ignored. With ``max_files_per_trigger=1`` every file is its own micro-batch,
i.e. its own run, oldest modification time first.

:func:`ingest` binds each file's cells by its own header, as the batch reader
does: the stream delivers lines, the headers of a micro-batch's files are
found among them in a Spark job, and the files are read grouped by header. Other
column orders and further columns are fine; a missing column or a row with more or
fewer cells than its header (``malformed_row``) stops the run.

The per-arrival columns (object URI, file name, arrival time, business date)
come from the file source's hidden ``_metadata`` column, per row.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.run import RunContext
from terrace.sources.files import csv_options, files_by_header, malformed_schema, read_by_header, sound_rows, text_lines

log = logging.getLogger(__name__)

BatchHandler = Callable[[DataFrame, RunContext], Any]


def event_columns() -> dict[str, Column]:
    """E2: arrival columns derived from the file metadata of each row."""
    uri = F.col("_metadata.file_path")
    arrived = F.col("_metadata.file_modification_time")
    return {
        "source_uri": uri,
        "bucket_name": F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/]*)/", 1),
        "object_key": F.regexp_extract(uri, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?/*(.*)$", 1),
        "source_filename": F.col("_metadata.file_name"),
        "event_time": arrived,
        "business_date": F.to_date(arrived),
    }


def landing_header(spark: SparkSession, landing_dir: str, glob: str = "*.csv") -> list[str]:
    """Column names from the header of the files already landed (first line only)."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("pathGlobFilter", glob)
    columns = reader.csv(landing_dir).columns
    if not columns:
        raise ValueError(f"No landed file under {landing_dir} to take the header from; pass the columns.")
    return columns


def landing_stream(
    spark: SparkSession,
    landing_dir: str,
    columns: list[str] | None,
    *,
    glob: str = "*.csv",
    max_files_per_trigger: int = 1,
) -> DataFrame:
    """E1: a stream of landing CSV rows (all text) plus the arrival columns.

    For queries that stay streaming from end to end. ``columns=None`` takes the
    header of the files already landed; every file must carry the same header
    in the same order (it is checked per file), and a row of another width is an
    error. :func:`ingest` binds files with different headers.
    """
    if columns is None:
        columns = landing_header(spark, landing_dir, glob)
    raw = (
        spark.readStream.schema(malformed_schema(columns))
        .options(**csv_options())
        .option("enforceSchema", False)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .csv(landing_dir)
    )
    raw = sound_rows(raw, columns)
    arrival = event_columns()
    return raw.select(*columns, *[value.alias(name) for name, value in arrival.items()])


def batch_run_id(checkpoint: str, batch_id: int) -> str:
    """Run id of a micro-batch: the same on a replay of that batch."""
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{checkpoint.rstrip('/')}#{batch_id}").hex


def ingest(
    spark: SparkSession,
    landing_dir: str,
    columns: list[str] | None,
    checkpoint: str,
    handler: BatchHandler,
    *,
    glob: str = "*.csv",
    max_files_per_trigger: int = 1,
    business_date: str | dt.date | None = None,
    run_id: str | None = None,
) -> int:
    """Process every file waiting in ``landing_dir`` (``availableNow``), one run per micro-batch.

    ``handler(batch_df, run)`` does the work of one run (usually the
    medallion chain). ``foreachBatch`` delivers at least once; handlers write
    with overwrite semantics and the run id is derived from the batch id, so a
    replayed batch writes the same result. A given ``business_date`` or
    ``run_id`` (a retry of named files) holds for every batch. Runs until all
    waiting files are done; returns how many batches this call handled.
    ``handler`` gets the rows bound by header name (``columns=None``: those of
    the batch's first file) and the arrival columns.
    """
    source = spark.readStream.format("text").option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files_per_trigger)
    stream = text_lines(source.load(landing_dir))
    processed_at = RunContext.create(business_date).processed_at_utc
    handled = 0

    def on_batch(batch_df: DataFrame, batch_id: int) -> None:
        nonlocal handled
        run = RunContext.create(business_date, run_id=run_id or batch_run_id(checkpoint, batch_id), processed_at_utc=processed_at)
        by_header = files_by_header(batch_df)
        if by_header:
            handler(read_by_header(batch_df.sparkSession, by_header, columns, extra=event_columns()), run)
        else:
            log.warning("Run %s: the landed files hold no line.", run.run_id)
        handled += 1

    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return handled
