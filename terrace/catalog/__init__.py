from terrace.catalog.tables import (
    add_partition,
    add_partitions,
    drop_partitions,
    ensure_database,
    projected_view,
    register_external_table,
    registered,
    repair,
    row_count,
    sync_partitions,
    synced_manifest,
)

__all__ = [
    "add_partition",
    "add_partitions",
    "drop_partitions",
    "ensure_database",
    "projected_view",
    "register_external_table",
    "registered",
    "repair",
    "row_count",
    "sync_partitions",
    "synced_manifest",
]
