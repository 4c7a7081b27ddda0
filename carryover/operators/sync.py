"""Tell the catalog only what changed in a registered tree.

``MSCK REPAIR`` hands every folder of the tree to the catalog each time.
Here the folders that hold files (one listing, as any read of the tree makes it; reduced to
distinct folders in tasks) and the catalog's partitions meet in one ``groupBy`` on the typed
partition values; only partitions that one side lacks come back, and are added or dropped ``BATCH`` in
a statement.  A tree that did not change costs no DDL at all.

Values are compared as the column's type sees them, so ``n=01`` is the
partition ``n = 1`` and is added once, at its own folder.  Two folders of one value, a folder
that is no value of its type, and files at another depth are errors, found before the first
statement: a table over them would miss rows.  Folders without files are no partitions.  Hidden files and
folders (``_``, ``.``) count for nothing.  A partition that the catalog keeps at
another folder (a replaced version) but whose value the tree has is left where it is.
Statements are repeatable (``IF [NOT] EXISTS``): after a failure, sync again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import quote_ref, sql_string
from ..sources.parquet import qualified_path
from .versions import BATCH, _is_managed, _spec
from .write import catalog_of, describe_table

DEFAULT = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Synced:
    """Partitions added and dropped, those left alone, and the DDL statements it took."""

    added: int
    dropped: int
    unchanged: int
    statements: int


def _text(segment: Column) -> Column:
    """A partition folder's value as text (``%XX`` undone; NULL for the default partition)."""
    raw = F.regexp_replace(segment, "^[^=]*=", "")
    plain = F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)
    return F.when(raw != DEFAULT, plain)


def _typed(rows: DataFrame, spec: str, parts: Sequence[tuple[str, str]]) -> DataFrame:
    """Adds ``v0, v1, …`` (typed), ``t0, t1, …`` (text) and ``fits`` for the specs in column ``spec``."""
    segments = F.split(spec, "/")
    fits = F.size(segments) == len(parts)
    for i, (name, kind) in enumerate(parts):
        segment = F.get(segments, i)
        rows = rows.withColumn(f"t{i}", _text(segment)).withColumn(f"v{i}", F.col(f"t{i}").try_cast(kind))
        named = F.lower(F.regexp_extract(segment, "^([^=]*)=", 1)) == name.lower()
        fits = fits & named & (F.col(f"v{i}").isNotNull() | F.col(f"t{i}").isNull())
    return rows.withColumn("fits", F.coalesce(fits, F.lit(False)))


def tree_folders(spark: SparkSession, path: str) -> DataFrame:
    """Folders below ``path`` that hold files: ``folder`` and ``spec`` (what follows ``path``)."""
    root = qualified_path(spark, path).rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return (
        files.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"))
        .distinct()
        .withColumn("spec", F.expr(f"substr(folder, {len(root) + 2})"))
    )


def partition_changes(spark: SparkSession, table: str, path: str, partition_columns: Sequence[str]) -> DataFrame:
    """Partitions that only the tree or only the catalog has, and folders that cannot be partitions.

    Columns ``t0, t1, …`` (values as text), ``folder`` (NULL: vanished), ``n_folders``, ``known`` and ``fits``.
    """
    ref = quote_ref(table)
    kinds = {f.name.lower(): f.dataType.simpleString() for f in spark.table(ref).schema.fields}
    parts = [(c, kinds[c.lower()]) for c in partition_columns]
    known = spark.sql(f"SHOW PARTITIONS {ref}").select(F.col("partition").alias("spec"))
    here = _typed(tree_folders(spark, path), "spec", parts)
    there = _typed(known.withColumn("folder", F.lit(None).cast("string")), "spec", parts).withColumn("fits", F.lit(True))
    values = [f"v{i}" for i in range(len(parts))]
    # folders that do not fit stand each for itself, so that none hides behind another
    odd = F.when(~F.col("fits"), F.col("folder"))
    return (
        here.unionByName(there)
        .groupBy(*values, odd.alias("odd"))
        .agg(
            *[F.min(f"t{i}").alias(f"t{i}") for i in range(len(parts))],
            F.min("folder").alias("folder"),
            F.max("folder").alias("other"),
            F.count("folder").alias("n_folders"),
            F.count_if(F.col("folder").isNull()).alias("known"),
            F.bool_and("fits").alias("fits"),
        )
        .where("NOT fits OR n_folders <> 1 OR known = 0")
    )


def sync_partitions(spark: SparkSession, table: str, path: str | None = None) -> Synced:
    """Add and drop what changed below ``path`` (the table's location if not given).

    For external tables of the session catalog: dropping a managed table's
    partition would delete files that arrived since the listing.
    """
    if catalog_of(spark, table) != "spark_catalog":
        raise ValueError("partitions are synced in the session catalog; other catalogs keep their own file lists")
    info = describe_table(spark, table)
    if info.location is None or info.partition_columns is None:
        raise ValueError(f"{table} has no folders of its own")
    ref, parts = quote_ref(table), list(info.partition_columns)
    if not parts:
        spark.catalog.refreshTable(ref)
        return Synced(0, 0, 0, 0)
    if _is_managed(spark, ref):
        raise ValueError(f"{table} is a managed table; only registered (external) trees are synced")
    before = spark.sql(f"SHOW PARTITIONS {ref}").count()
    added, dropped = [], []
    for row in partition_changes(spark, table, path or info.location, parts).toLocalIterator():
        if not row["fits"]:
            raise ValueError(f"{row['folder']} is no partition of {table} by {', '.join(parts)}")
        texts = tuple(row[f"t{i}"] for i in range(len(parts)))
        if row["n_folders"] > 1:
            raise ValueError(f"{row['folder']} and {row['other']} hold one partition of {table}")
        if row["n_folders"]:
            added.append(f"PARTITION ({_spec(parts, texts)}) LOCATION {sql_string(row['folder'])}")
        else:
            dropped.append(f"PARTITION ({_spec(parts, texts)})")
    statements = [f"ALTER TABLE {ref} ADD IF NOT EXISTS {' '.join(b)}" for b in _batches(added)]
    statements += [f"ALTER TABLE {ref} DROP IF EXISTS {', '.join(b)}" for b in _batches(dropped)]
    for statement in statements:
        spark.sql(statement)
    spark.catalog.refreshTable(ref)
    return Synced(len(added), len(dropped), before - len(dropped), len(statements))


def _batches(items: Iterable[str]) -> list[list[str]]:
    every = sorted(items)
    return [every[i : i + BATCH] for i in range(0, len(every), BATCH)]
