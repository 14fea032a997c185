from terrace.sinks import versions
from terrace.sinks.files import (
    CSV_OPTIONS,
    EmptyResultError,
    ReadBackError,
    SelfOverwriteError,
    content_sums,
    guard_not_input,
    overwrite_full,
    overwrite_numeric_partitions,
    overwrite_partitions,
    partition_location,
    readback_counts,
    verify_partitions,
    write_single_file,
)

__all__ = [
    "CSV_OPTIONS",
    "EmptyResultError",
    "ReadBackError",
    "SelfOverwriteError",
    "content_sums",
    "guard_not_input",
    "overwrite_full",
    "overwrite_numeric_partitions",
    "overwrite_partitions",
    "partition_location",
    "readback_counts",
    "verify_partitions",
    "versions",
    "write_single_file",
]
