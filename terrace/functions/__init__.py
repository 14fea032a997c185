from terrace.functions.columns import (
    SCORE_LABELS,
    SOURCE_COLUMN,
    YES_NO_TRUE,
    business_date_columns,
    file_name,
    iso_date_text,
    lineage_columns,
    normalize_text,
    score_label,
    to_bigint,
    to_decimal,
    to_int,
    yes_no,
)

__all__ = [
    "SCORE_LABELS",
    "SOURCE_COLUMN",
    "YES_NO_TRUE",
    "business_date_columns",
    "file_name",
    "iso_date_text",
    "lineage_columns",
    "normalize_text",
    "score_label",
    "to_bigint",
    "to_decimal",
    "to_int",
    "yes_no",
]
