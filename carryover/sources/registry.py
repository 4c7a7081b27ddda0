"""Pick a source by kind."""

from __future__ import annotations

from .arrow_files import SPLIT_BYTES, ArrowSource
from .base import Source
from .catalog import CatalogSource
from .parquet import ParquetSource

KINDS = ("hive", "catalog", "parquet", "arrow")


def flag(value: object) -> bool:
    """A yes/no setting from YAML or the environment: booleans, 0/1, true/false, yes/no, on/off."""
    if isinstance(value, bool) or value is None:
        return bool(value)
    if isinstance(value, (int, float)):
        return value != 0
    text = str(value).strip().lower()
    if text in ("true", "yes", "on", "1"):
        return True
    if text in ("false", "no", "off", "0", ""):
        return False
    raise ValueError(f"not a yes/no value: {value!r}")


def get_source(kind: str, **options: object) -> Source:
    """``hive`` needs ``metastore_uri``; ``catalog`` uses the session's catalog."""
    if kind == "hive":
        if not options.get("metastore_uri"):
            raise ValueError("source kind 'hive' needs metastore_uri")
        return CatalogSource(
            database=str(options.get("database") or "default"),
            metastore_uri=str(options["metastore_uri"]),
        )
    if kind == "catalog":
        return CatalogSource(database=str(options.get("database") or "default"))
    if kind == "parquet":
        return ParquetSource(
            merge_schema=flag(options.get("merge_schema", False)), reconcile=flag(options.get("reconcile", False))
        )
    if kind == "arrow":
        columns = options.get("columns") or ()
        return ArrowSource(
            columns=tuple(str(c) for c in columns),  # type: ignore[attr-defined]
            split_bytes=int(options.get("split_bytes") or SPLIT_BYTES),  # type: ignore[call-overload]
        )
    raise ValueError(f"unknown source kind {kind!r}; supported: {', '.join(KINDS)}")
