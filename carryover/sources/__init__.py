"""Sources: catalog tables and Parquet paths."""

from .arrow_files import ArrowSource, register_arrow_files
from .base import Source
from .catalog import CatalogSource
from .parquet import ParquetSource, file_schema, path_relation, qualified_path, read_parquet, scan_path_sql
from .reconcile import SchemaConflict, common_type, read_reconciled
from .registry import get_source
from .storage import s3a_settings

__all__ = [
    "ArrowSource",
    "CatalogSource",
    "ParquetSource",
    "SchemaConflict",
    "Source",
    "common_type",
    "file_schema",
    "get_source",
    "path_relation",
    "qualified_path",
    "read_parquet",
    "read_reconciled",
    "register_arrow_files",
    "s3a_settings",
    "scan_path_sql",
]
