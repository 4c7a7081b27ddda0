"""Session settings for the target catalogs, as plain dicts.

Each profile is the set of ``spark.sql.catalog.<name>.*`` settings the
reference applies for that catalog kind.  ``session`` is the offline
profile: the built-in session catalog with Parquet tables, which every
test and query key uses.  The table-format runtime itself (jars) is a
deployment matter: pass it with ``extra_packages`` or ``spark-submit``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from ..sources.base import Source

ICEBERG_CATALOG = "org.apache.iceberg.spark.SparkCatalog"
ICEBERG_EXTENSIONS = "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"

# The catalog implementations and the I/O class each kind needs.
GLUE_CATALOG_IMPL = "org.apache.iceberg.aws.glue.GlueCatalog"
S3_FILE_IO = "org.apache.iceberg.aws.s3.S3FileIO"
S3_TABLES_CATALOG_IMPL = "software.amazon.s3tables.iceberg.S3TablesCatalog"

KINDS = ("session", "hadoop", "nessie", "glue", "s3_tables")


def catalog_settings(
    kind: str,
    name: str = "iceberg",
    *,
    warehouse: str | None = None,
    uri: str | None = None,
    region: str = "us-east-1",
) -> dict[str, str]:
    """Settings for one target catalog kind; unknown kinds are an error."""
    if kind == "session":
        return {}
    prefix = f"spark.sql.catalog.{name}"
    if kind == "hadoop":  # C1
        _need(kind, warehouse=warehouse)
        return {prefix: ICEBERG_CATALOG, f"{prefix}.type": "hadoop", f"{prefix}.warehouse": str(warehouse)}
    if kind == "nessie":  # C2
        _need(kind, uri=uri, warehouse=warehouse)
        return {
            prefix: ICEBERG_CATALOG,
            f"{prefix}.type": "rest",
            f"{prefix}.uri": str(uri),
            f"{prefix}.warehouse": str(warehouse),
        }
    if kind == "glue":  # C3
        _need(kind, warehouse=warehouse)
        return {
            prefix: ICEBERG_CATALOG,
            f"{prefix}.catalog-impl": GLUE_CATALOG_IMPL,
            f"{prefix}.warehouse": str(warehouse),
            f"{prefix}.io-impl": S3_FILE_IO,
            f"{prefix}.region": region,
        }
    if kind == "s3_tables":  # C4
        _need(kind, warehouse=warehouse)
        return {
            prefix: ICEBERG_CATALOG,
            f"{prefix}.catalog-impl": S3_TABLES_CATALOG_IMPL,
            f"{prefix}.warehouse": str(warehouse),
            f"{prefix}.region": region,
        }
    raise ValueError(f"unknown catalog kind {kind!r}; one of {', '.join(KINDS)}")  # C5


def can_register(kind: str) -> bool:
    """Managed table buckets cannot adopt outside files, so C4 refuses ``register``."""
    if kind not in KINDS:
        raise ValueError(f"unknown catalog kind {kind!r}")
    return kind != "s3_tables"


def _need(kind: str, **values: str | None) -> None:
    missing = [k for k, v in values.items() if not v]
    if missing:
        raise ValueError(f"catalog kind {kind!r} needs {', '.join(missing)}")


def session_settings(
    *,
    source: Source | None = None,
    catalog_kind: str = "session",
    catalog_name: str = "iceberg",
    catalog_options: Mapping[str, str] | None = None,
    storage: Mapping[str, str] | None = None,
    extra_packages: Sequence[str] = (),
    extra_config: Mapping[str, str] | None = None,
    driver_memory: str | None = None,
) -> dict[str, str]:
    """All settings of one run: source (S7), catalog (C1–C5), storage (S11), overrides last."""
    settings: dict[str, str] = {}
    if driver_memory:
        settings["spark.driver.memory"] = driver_memory
    if catalog_kind != "session":
        settings["spark.sql.extensions"] = ICEBERG_EXTENSIONS
    if source is not None:
        settings.update(source.session_settings())
    settings.update(catalog_settings(catalog_kind, catalog_name, **dict(catalog_options or {})))
    settings.update(dict(storage or {}))
    packages = [p for p in extra_packages if p]
    if packages:
        settings["spark.jars.packages"] = ",".join(packages)
    settings.update(dict(extra_config or {}))
    return settings


def build_session(settings: Mapping[str, str], *, master: str | None = None, app_name: str = "carryover") -> SparkSession:
    """Start (or join) a session with ``settings``.  The caller owns it and stops it."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    if settings.get("spark.sql.catalogImplementation") == "hive":
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()
