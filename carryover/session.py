"""Session helpers: the shared scratch location and a local session for tests.

Every table or file the library writes on its own behalf (query keys,
scratch databases) goes under the shared folder the cluster names in
``spark.checkpoint.dir``.  It is read from the session; only a *local*
session without that setting gets a fresh temporary folder of its own.
A cluster session without it is an error: a machine-local folder would be
invisible to the executors.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

from .functions.names import quote_ident, sql_string


_LOCAL_ROOTS: dict[int, str] = {}  # local sessions without a configured checkpoint folder


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - some confs are not readable in every mode
        value = None
    return value or None


def _is_local(spark: SparkSession) -> bool:
    master = _conf(spark, "spark.master") or ""
    return master == "local" or master.startswith("local[")  # local-cluster has executors of its own


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for the library's own tables and files."""
    root = _conf(spark, "spark.checkpoint.dir")
    if root is None:
        try:
            root = spark.sparkContext.getCheckpointDir()  # type: ignore[assignment]
        except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
            root = None
    if root is None:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; set it to a folder every executor can reach"
            )
        root = _LOCAL_ROOTS.get(id(spark))
        if root is None:
            root = tempfile.mkdtemp(prefix="carryover-")
            try:  # the context adds a folder of its own below; use that one from now on
                spark.sparkContext.setCheckpointDir(root)
                root = spark.sparkContext.getCheckpointDir() or root
            except Exception:  # noqa: BLE001 - Spark Connect: keep the folder for this session
                pass
            _LOCAL_ROOTS[id(spark)] = root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new, unique folder name under :func:`scratch_root` (not created)."""
    return f"{scratch_root(spark)}/carryover/{tag}-{uuid.uuid4().hex[:12]}"


def scratch_database(spark: SparkSession, tag: str) -> tuple[str, str]:
    """Create a uniquely named database whose managed tables live in scratch.

    Returns ``(database, location)``.
    """
    location = scratch_path(spark, tag)
    name = f"{tag}_{uuid.uuid4().hex[:12]}"
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {quote_ident(name)} LOCATION {sql_string(location)}"
    )
    return name, location


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session as used by tests and the bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("carryover")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CARRYOVER_DRIVER_MEMORY", "8g"))
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
