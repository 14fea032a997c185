"""Column functions used by the table transforms (all JVM-side built-ins).

Each function returns a ``Column``; nothing here runs Python per row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace.run import RunContext

# Text accepted as TRUE by the yes/no flag (after trim + lower).
YES_NO_TRUE = ("yes", "true")

# Column in which a landing read keeps each row's file name.
SOURCE_COLUMN = "_source_file"

# Labels for a 1..4 score.
SCORE_LABELS = {1: "low", 2: "medium", 3: "high", 4: "very_high"}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: str | Column) -> Column:
    """``TRIM(LOWER(x))``: lower case, leading/trailing spaces removed."""
    return F.trim(F.lower(_col(c)))


def to_int(c: str | Column) -> Column:
    """Text to INT; text that is not a whole number becomes NULL.

    NULL is then reported by the non-null rule naming the column, instead of
    failing the whole job inside a cast.
    """
    return _col(c).try_cast("int")


def to_bigint(c: str | Column) -> Column:
    return _col(c).try_cast("bigint")


def to_decimal(c: str | Column, precision: int = 12, scale: int = 2) -> Column:
    """Text to DECIMAL(p,s), rounding half up; overflow becomes NULL."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def yes_no(c: str | Column, truthy: Iterable[str] = YES_NO_TRUE) -> Column:
    """TRUE when the trimmed lower-case text is one of ``truthy``; otherwise FALSE, NULL included."""
    values = [str(v) for v in truthy]
    return F.coalesce(normalize_text(_col(c).cast("string")).isin(values), F.lit(False))


def score_label(c: str | Column, labels: Mapping[int, str] = SCORE_LABELS) -> Column:
    """Label for a score; NULL when the score has no label."""
    source = _col(c)
    expr = None
    for score, label in labels.items():
        expr = F.when(source == F.lit(score), F.lit(label)) if expr is None else expr.when(source == F.lit(score), F.lit(label))
    return expr


def iso_date_text(c: str | Column, when_empty: Column | None = None) -> Column:
    """DATE from date or timestamp text: the text is cut at ``T`` or at the first space.

    Empty or NULL text gives ``when_empty``, NULL by default (a run's date uses
    ``current_date()``, as :func:`terrace.run.parse_business_date` does); text
    that is no date gives NULL.
    """
    text = F.trim(_col(c).cast("string"))
    parsed = F.try_to_date(F.regexp_extract(text, r"^([^T ]*)", 1), "yyyy-MM-dd")
    if when_empty is None:
        return parsed
    return F.when(F.coalesce(text, F.lit("")) == "", when_empty.cast("date")).otherwise(parsed)


def file_name(c: str | Column) -> Column:
    """Last path segment of a URI (a trailing ``/`` is ignored)."""
    return F.regexp_extract(F.regexp_replace(_col(c), "/+$", ""), r"([^/]*)$", 1)


def lineage_columns(run: RunContext, source_file: Column | None = None) -> dict[str, Column]:
    """``source_file``, ``run_id`` and ``processed_at_utc`` for one run.

    One value per run (literals, not ``uuid()``), so every row of a run agrees
    and a replayed batch writes the same values. ``source_file`` is the run's
    landing file name, or a per-row column such as ``_metadata.file_name``.
    """
    if source_file is None:
        # The run's own file name if one was given, else the file each row was read from.
        source_file = F.col(SOURCE_COLUMN) if run.source_file is None else F.lit(run.source_file)
    return {
        "source_file": source_file.cast("string"),
        "run_id": F.lit(run.run_id).cast("string"),
        "processed_at_utc": F.lit(run.processed_at_utc).cast("timestamp"),
    }


def business_date_columns(value: dt.date | str | Column) -> dict[str, Column]:
    """``ingestion_date`` DATE and ``year``/``month``/``day`` INT.

    From a run's business date (literals) or derived per row from a date or
    timestamp column.
    """
    if isinstance(value, Column):
        day = value.cast("date")
        return {
            "ingestion_date": day,
            "year": F.year(day).cast("int"),
            "month": F.month(day).cast("int"),
            "day": F.dayofmonth(day).cast("int"),
        }
    if isinstance(value, str):
        from terrace.run import parse_business_date

        value = parse_business_date(value)
    return {
        "ingestion_date": F.lit(value.isoformat()).cast("date"),
        "year": F.lit(value.year).cast("int"),
        "month": F.lit(value.month).cast("int"),
        "day": F.lit(value.day).cast("int"),
    }
