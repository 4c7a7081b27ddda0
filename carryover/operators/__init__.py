"""Data operators: shaping, writing, registering, validating, file statistics."""

from .difference import difference, rows_not_in
from .once import Appended, append_once
from .register import Layout, Registered, add_files_sql, create_table_sql, infer_layout, layout_rows, register_files
from .sketches import (
    compact_statistics,
    estimates,
    merge_sketches,
    partition_sketches,
    read_statistics,
    record_statistics,
)
from .stats import file_stats, partition_stats
from .sync import Synced, sync_partitions
from .transforms import limit_rows, prepare_for_write, replicate_partitions, tag_partition
from .validate import compare, count_rows, fingerprint, fingerprint_exprs, fingerprint_pair, subtract_fingerprint
from .write import (
    MODES,
    Exported,
    Written,
    ensure_namespace,
    export_partitioned,
    is_v1_target,
    load_overwrite,
    table_exists,
    table_partition_columns,
    write_table,
)

__all__ = [
    "MODES",
    "Appended",
    "Exported",
    "Layout",
    "Registered",
    "Synced",
    "Written",
    "add_files_sql",
    "append_once",
    "compact_statistics",
    "compare",
    "count_rows",
    "create_table_sql",
    "difference",
    "ensure_namespace",
    "estimates",
    "export_partitioned",
    "file_stats",
    "fingerprint",
    "fingerprint_exprs",
    "fingerprint_pair",
    "infer_layout",
    "is_v1_target",
    "layout_rows",
    "limit_rows",
    "load_overwrite",
    "merge_sketches",
    "partition_sketches",
    "partition_stats",
    "prepare_for_write",
    "read_statistics",
    "record_statistics",
    "register_files",
    "replicate_partitions",
    "rows_not_in",
    "subtract_fingerprint",
    "sync_partitions",
    "table_exists",
    "table_partition_columns",
    "tag_partition",
    "write_table",
]
