"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import scratch_path

CHUNK_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Send this library's modules to the executors, once per session.

    The functions of the operators run in Python workers, which need to import
    them also where the library isn't installed on the executors.
    """
    context = spark.sparkContext
    if getattr(context, "_terrace_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="terrace-code-")), "terrace_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, f"{package.name}/{source.relative_to(package)}")
    context.addPyFile(archive)
    context._terrace_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage: later jobs, and recomputed tasks after a lost executor,
    read the same rows again, so row numbers and samples stay fixed.
    """
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    name = f"__{name}"
    while name.lower() in taken:
        name += "_"
    return name


def id_remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id's text modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % F.lit(divisor)


def text_chunks(array: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a string array into runs of rows of at most ``limit`` UTF-8 bytes (one row at least).

    Yields (first row, bytes, offsets from 0). Null texts are empty.
    """
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = pc.fill_null(array, "")
    if len(array) == 0:
        return
    width = np.int64 if pa.types.is_large_string(array.type) else np.int32
    offsets = np.frombuffer(array.buffers()[1], width)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    body = array.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(array):
        until = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        until = min(max(until, row + 1), len(array))
        yield row, data[offsets[row] : offsets[until]], offsets[row : until + 1] - offsets[row]
        row = until
