"""Plans over operators: the check runner, batch migration, catalog profiles."""

from .batch import MigrationOptions, migrate_table, plan_targets, run_migration, select_tables, summarize
from .checks import (
    Check,
    CheckRun,
    copy_check_text,
    count_equal_sql,
    distinct_partitions_sql,
    info_sql,
    load_checks,
    non_empty_sql,
    parse_checks,
    partition_has_rows_sql,
    register_check_text,
    run_check_file,
    run_checks,
)
from .profiles import build_session, can_register, catalog_settings, session_settings
from .staging import stage_exports, stage_tables

__all__ = [
    "Check",
    "CheckRun",
    "MigrationOptions",
    "build_session",
    "can_register",
    "catalog_settings",
    "copy_check_text",
    "count_equal_sql",
    "distinct_partitions_sql",
    "info_sql",
    "load_checks",
    "migrate_table",
    "non_empty_sql",
    "parse_checks",
    "partition_has_rows_sql",
    "plan_targets",
    "register_check_text",
    "run_check_file",
    "run_checks",
    "run_migration",
    "select_tables",
    "session_settings",
    "stage_exports",
    "stage_tables",
    "summarize",
]
