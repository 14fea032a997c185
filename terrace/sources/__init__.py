from terrace.sources.files import (
    land_files,
    read_csv_strings,
    read_current,
    read_numeric_partitions,
    read_parquet,
    read_partitioned,
    read_table,
    resolve_landing_source,
    sql_over,
    string_schema,
)

__all__ = [
    "land_files",
    "read_csv_strings",
    "read_current",
    "read_numeric_partitions",
    "read_parquet",
    "read_partitioned",
    "read_table",
    "resolve_landing_source",
    "sql_over",
    "string_schema",
]
