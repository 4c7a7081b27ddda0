"""Run configuration from a YAML file with the same layout as the reference's.

Only the driver reads this small file; it becomes a ``Source``,
``MigrationOptions`` and a dict of session settings.  Blocks:
``source`` (``type: hive|catalog|parquet``, ``database``, ``hive.metastore_uri``),
``target`` (``catalog_type``, ``catalog_name``, ``database`` and one nested
block per catalog kind), ``storage``, ``spark``, ``tables``, ``migration``.
``catalog_type: session`` is the offline profile (session catalog, Parquet).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from .plans.batch import MigrationOptions
from .plans.profiles import KINDS, can_register, session_settings
from .sources import get_source, s3a_settings
from .sources.registry import flag
from .sources.base import Source


@dataclass(frozen=True)
class RunConfig:
    source: Source
    options: MigrationOptions
    settings: dict[str, str]
    tables: tuple[str, ...] = ()
    master: str | None = None
    app_name: str = "carryover"
    catalog_kind: str = "session"
    extra: Mapping[str, Any] = field(default_factory=dict)
    targets: Mapping[str, str] = field(default_factory=dict)  # table -> explicit target name
    pool: str | None = None  # FAIR scheduler pool of the batch's jobs
    timeout: float | None = None  # seconds a table may take
    retries: int = 0
    longest_first: bool = False


MIGRATION_KEYS = frozenset({
    "write_mode", "repartition", "partition_by", "register_partition_columns", "verify",
    "staged_replace", "cluster", "writer_options", "targets", "scheduler_pool", "register_incremental",
    "timeout", "retries", "longest_first",
})


def _block(raw: Mapping[str, Any], key: str) -> dict[str, Any]:
    value = raw.get(key) or {}
    if not isinstance(value, Mapping):
        raise ValueError(f"config block {key!r} must be a mapping")
    return dict(value)


def parse_config(raw: Mapping[str, Any]) -> RunConfig:
    """Turn the parsed YAML mapping into a :class:`RunConfig`, with clear errors."""
    if "source" not in raw or "target" not in raw:
        raise ValueError("config needs 'source' and 'target' blocks")
    src = _block(raw, "source")
    kind = src.get("type", "hive")
    if kind == "hive":
        hive = _block(src, "hive")
        if src.get("metastore_uri") and not hive.get("metastore_uri"):  # the flat layout
            hive["metastore_uri"] = src["metastore_uri"]
        if not hive.get("metastore_uri"):
            raise ValueError("source.hive.metastore_uri is required when source.type is 'hive'")
        source = get_source(
            "hive", metastore_uri=hive["metastore_uri"], database=hive.get("database") or src.get("database") or "default"
        )
    else:
        source = get_source(
            kind,
            database=src.get("database") or "default",
            merge_schema=src.get("merge_schema", False),
            reconcile=src.get("reconcile", False),
            columns=src.get("columns"),
            split_bytes=src.get("split_bytes"),
        )

    tgt = _block(raw, "target")
    catalog_kind = tgt.get("catalog_type")
    if catalog_kind not in KINDS:
        raise ValueError(f"target.catalog_type must be one of {', '.join(KINDS)}")
    catalog_name = "spark_catalog" if catalog_kind == "session" else tgt.get("catalog_name", "iceberg")
    catalog_options: dict[str, Any] = {}
    if catalog_kind != "session":
        nested = tgt.get(catalog_kind)
        if not isinstance(nested, Mapping):
            raise ValueError(f"target.{catalog_kind} block is required for catalog_type {catalog_kind!r}")
        catalog_options = {k: v for k, v in nested.items() if k in ("warehouse", "uri", "region")}

    storage = _block(raw, "storage")
    store = s3a_settings(
        storage.get("endpoint"),
        storage.get("access_key"),
        storage.get("secret_key"),
        path_style_access=flag(storage.get("path_style_access", True)),
        bucket=storage.get("bucket"),
    )
    spark_block = _block(raw, "spark")
    extra_config = _block(spark_block, "extra_config")
    settings = session_settings(
        source=source,
        catalog_kind=catalog_kind,
        catalog_name=catalog_name,
        catalog_options=catalog_options,
        storage=store,
        extra_packages=list(spark_block.get("extra_packages") or []),
        extra_config={str(k): str(v) for k, v in extra_config.items()},
        driver_memory=spark_block.get("driver_memory"),
    )

    mig = _block(raw, "migration")
    unknown = sorted(set(mig) - MIGRATION_KEYS)
    if unknown:
        raise ValueError(f"unknown migration keys {', '.join(unknown)}; known are {', '.join(sorted(MIGRATION_KEYS))}")
    mode = mig.get("write_mode", "create")
    if mode == "register" and not can_register(catalog_kind):
        raise ValueError(f"catalog_type {catalog_kind!r} cannot register existing files")
    reg_cols = mig.get("register_partition_columns")
    options = MigrationOptions(
        mode=mode,
        catalog=catalog_name,
        database=tgt.get("database") or "default",
        fmt="parquet" if catalog_kind == "session" else "iceberg",
        repartition=mig.get("repartition") or None,
        partition_by=tuple(mig.get("partition_by") or ()),
        register_partition_columns=tuple(reg_cols) if reg_cols else None,
        verify=mig.get("verify", "count"),
        staged_replace=flag(mig.get("staged_replace", True)),
        cluster=mig.get("cluster") or "rebalance",
        incremental=flag(mig.get("register_incremental", False)),
        writer_options={str(k): str(v) for k, v in _block(mig, "writer_options").items()},
    )
    options.validate()
    tables = raw.get("tables") or []
    if not isinstance(tables, (list, tuple)):
        raise ValueError("'tables' must be a list")
    return RunConfig(
        source=source,
        options=options,
        settings=settings,
        tables=tuple(str(t) for t in tables if t),
        master=spark_block.get("master"),
        app_name=spark_block.get("app_name", "carryover"),
        catalog_kind=catalog_kind,
        targets={str(k): str(v) for k, v in _block(mig, "targets").items()},
        pool=mig.get("scheduler_pool"),
        timeout=float(mig["timeout"]) if mig.get("timeout") else None,
        retries=int(mig.get("retries") or 0),
        longest_first=flag(mig.get("longest_first", False)),
    )


def load_config(path: str | Path) -> RunConfig:
    import yaml

    p = Path(path)
    if not p.exists():
        raise FileNotFoundError(f"config file not found: {p}")
    raw = yaml.safe_load(p.read_text()) or {}
    if not isinstance(raw, Mapping):
        raise ValueError("config file must hold a mapping")
    return parse_config(raw)
