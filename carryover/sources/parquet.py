"""Parquet files, directories and globs, local or object store.

Reads are plain ``spark.read.parquet``: file listing is distributed by
Spark once a directory holds more than
``spark.sql.sources.parallelPartitionDiscovery.threshold`` paths, schema
inference reads footers only, and filters on ``key=value`` directory
columns prune whole directories at planning time.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..functions.names import path_stem, path_table_name, quote_ident, target_table_name


@dataclass(frozen=True)
class ParquetSource:
    """Reads Parquet paths.  ``merge_schema`` adds columns that some files lack; ``reconcile``
    (a folder) also brings columns of different types to a common one (:mod:`.reconcile`)."""

    merge_schema: bool = False
    reconcile: bool = False
    kind: str = "parquet"

    def session_settings(self) -> dict[str, str]:  # S8: Parquet is built in
        return {}

    def resolve(self, ref: str) -> str:  # S4
        return path_stem(ref)

    def target_name(self, ref: str) -> str:
        return target_table_name(path_table_name(ref))

    def read(self, spark: SparkSession, ref: str) -> DataFrame:  # S3
        if self.reconcile:
            from .reconcile import read_reconciled

            return read_reconciled(spark, ref)
        return read_parquet(spark, ref, merge_schema=self.merge_schema)


def read_parquet(
    spark: SparkSession,
    path: str,
    *,
    merge_schema: bool = False,
    base_path: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Read a path with partition discovery.

    ``base_path`` is needed when ``path`` is a glob below the table root
    (``root/ds=2024-*``), so that ``ds`` is still discovered as a column.
    ``schema`` fixes column and partition-column types instead of inferring.
    """
    reader = spark.read
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    if base_path:
        reader = reader.option("basePath", base_path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def qualified_path(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and authority of the file system it lives on.

    A relative path is resolved the way readers resolve it (against the file
    system's working folder), not against a database folder as ``LOCATION``
    would; two spellings of one folder compare equal once qualified.
    """
    try:
        jvm = spark.sparkContext._jvm  # type: ignore[attr-defined]
        try:  # the readers' configuration: session-level spark.hadoop.* settings included
            conf = spark._jsparkSession.sessionState().newHadoopConf()  # type: ignore[attr-defined]
        except Exception:  # noqa: BLE001
            conf = spark.sparkContext._jsc.hadoopConfiguration()  # type: ignore[attr-defined]
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        return str(hpath.getFileSystem(conf).makeQualified(hpath).toString())
    except Exception:  # noqa: BLE001 - no JVM handle (Spark Connect)
        if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", path) or path.startswith("/"):
            return path  # already has a scheme (s3a://…, file:/…) or is absolute
        return os.path.abspath(path)


def file_schema(spark: SparkSession, path: str, *, merge_schema: bool = False) -> StructType:
    """Schema of the data files alone, without directory partition columns."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.parquet(path).schema


def path_relation(path: str) -> str:
    """A path as a SQL relation, e.g. ``SELECT * FROM parquet.`/x/y```."""
    return f"parquet.{quote_ident(path)}"


def scan_path_sql(spark: SparkSession, path: str, columns: str = "*") -> DataFrame:
    """Query a path directly in SQL without registering a table."""
    return spark.sql(f"SELECT {columns} FROM {path_relation(path)}")
