"""K1–K3, K5–K7: writing DataFrames to catalog tables and to partitioned files.

One contract for both kinds of catalog:

* **V2 catalogs** (Iceberg and the like, or any catalog other than the
  session catalog): ``DataFrameWriterV2`` — ``create``, ``createOrReplace``,
  ``append`` — as in the reference.
* **The session catalog with a file format** (``spark_catalog`` + Parquet,
  the offline ``session`` profile): ``DataFrameWriterV2`` cannot replace or
  append there, so the V1 writer is used with the same contract: create
  fails if the table exists, append fails if it does not (V1 ``append``
  would silently create it), replace swaps schema and contents.  Replace
  goes through a staging table by default (``staged=True``); Spark's own V1
  replace is drop-and-write and cannot read its own target.

Every write carries an ``Observation``.  With the V1 writer it sits directly
above the write, in its final stage, where Spark applies a task's metric
update once per successful task, so the count survives lost executors and
retried tasks.  A V2 table may add a shuffle of its own above it (its
distribution and ordering); then the count is that of a map stage, where a
retried task can count again, and the recount of the target decides.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.names import quote_ident, quote_ref, split_ref, sql_col, sql_string
from .transforms import prepare_for_write
from .validate import combine, fingerprint_exprs
from .versions import can_point, point_to

MODES = ("create", "replace", "append")
V1_FORMATS = frozenset({"parquet", "orc", "csv", "json", "avro", "text", "hive"})


@dataclass
class Written:
    """What one write put into the target, measured in the write's own scan."""

    table: str
    mode: str
    rows: int
    fingerprint: dict[str, object] | None = None
    partition_by: tuple[str, ...] = field(default_factory=tuple)


def catalog_of(spark: SparkSession, table: str) -> str:
    parts = split_ref(table)
    if len(parts) >= 3:
        return parts[0]
    return spark.catalog.currentCatalog()


def is_v1_target(spark: SparkSession, table: str, fmt: str) -> bool:
    return catalog_of(spark, table) == "spark_catalog" and fmt.lower() in V1_FORMATS


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(quote_ref(table))


@dataclass(frozen=True)
class TableInfo:
    """What the catalog says about a table, from one ``DESCRIBE TABLE EXTENDED``."""

    provider: str | None
    location: str | None
    partition_columns: tuple[str, ...] | None  # None: partitioned by transforms, not columns


def describe_table(spark: SparkSession, table: str) -> TableInfo:
    """Provider, location and partition columns of a table (one metadata command, no job)."""
    rows = [(r[0] or "", r[1] or "") for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quote_ref(table)}").collect()]
    details: dict[str, str] = {}
    parts: list[str] = []
    transforms = False
    section = None
    for name, value in rows:
        name, value = name.strip(), value.strip()
        if name.startswith("# col_name"):  # column header inside a section
            continue
        if name.startswith("#"):
            section = name
            continue
        if not name:
            section = None
            continue
        if section == "# Partition Information":  # one row per partition column
            parts.append(_unquote(name))
        elif section == "# Partitioning":  # V2 catalogs: "Part n" -> column or transform
            if re.fullmatch(r"`(?:[^`]|``)*`|[A-Za-z_]\w*", value):
                parts.append(_unquote(value))
            else:  # days(ts), bucket(16, id), …
                transforms = True
        elif section == "# Detailed Table Information":
            details[name] = value
    return TableInfo(
        provider=(details.get("Provider") or "").lower() or None,
        location=details.get("Location") or None,
        partition_columns=None if transforms else tuple(parts),
    )


def _unquote(name: str) -> str:
    """Drop the back-quotes around a quoted name (doubled ones inside become one)."""
    if len(name) >= 2 and name.startswith("`") and name.endswith("`"):
        return name[1:-1].replace("``", "`")
    return name


def table_partition_columns(spark: SparkSession, table: str) -> list[str] | None:
    """Identity partition columns of a table; ``None`` if its partitioning is not plain
    columns (a V2 table partitioned by ``days(ts)``, ``bucket(…)``, …)."""
    cols = describe_table(spark, table).partition_columns
    return None if cols is None else list(cols)


def table_provider(spark: SparkSession, table: str) -> str | None:
    """The data source of a table (``parquet``, ``orc``, ``iceberg`` …), if it has one."""
    return describe_table(spark, table).provider


def table_location(spark: SparkSession, table: str) -> str | None:
    """Where a table keeps its files, if the catalog says."""
    return describe_table(spark, table).location


def same_location(a: str, b: str) -> bool:
    """Compare two folder names, ignoring a ``file:`` scheme and trailing slashes."""

    def norm(p: str) -> str:
        p = unquote(p).rstrip("/")
        return re.sub(r"^file:/*", "/", p)

    return norm(a) == norm(b)


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """K5: ``CREATE NAMESPACE IF NOT EXISTS``, every name part back-quoted."""
    loc = f" LOCATION {sql_string(location)}" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quote_ref(namespace)}{loc}")


def namespace_of(table: str) -> str | None:
    parts = split_ref(table)
    return ".".join(quote_ident(p) for p in parts[:-1]) if len(parts) > 1 else None


def _observed(df: DataFrame, fingerprint: bool, as_types=None, empty_as_null=()) -> tuple[DataFrame, Observation]:
    obs = Observation(f"carryover_write_{uuid.uuid4().hex[:12]}")
    if fingerprint:
        exprs = fingerprint_exprs(df, as_types=as_types, empty_as_null=empty_as_null)
    else:
        exprs = [F.count(F.lit(1)).alias("rows")]
    return df.observe(obs, *exprs), obs


def write_table(
    df: DataFrame,
    table: str,
    mode: str = "create",
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    repartition: int | str | None = None,
    input_partition_columns: Sequence[str] | None = None,
    fingerprint: bool = False,
    options: dict[str, str] | None = None,
    target_info: TableInfo | None = None,
    staged: bool | str = True,
    cluster: str = "rebalance",
) -> Written:
    """K1 create, K2 replace, K3 append (T1, T2 applied on the way).

    ``target_info``: the append target's :func:`describe_table`, if the
    caller already has it (saves a catalog round trip per table).

    ``staged=True``, the default (session-catalog replace only): write the new
    rows to a staging table next to the target first, then rename the target
    aside, the staging table into its place, and drop the old one.  A failure
    while writing leaves the old table untouched (and the new rows may come
    from it); a failed rename puts the old table back.  Between the two renames
    the name has no table: a driver that dies there leaves it as
    ``name__replaced_*``, and the next write to the name restores it first
    (:func:`restore_replaced`).  Renaming moves the table folder, which is cheap
    on HDFS and local disks but a copy on object stores (``staged=False`` there,
    if a lost table can be had again); V2 catalogs replace atomically without it.

    ``cluster``: see :func:`prepare_for_write`; a V2 table clusters its own
    writes, so none is added for it.

    ``partition_by`` on append must match the table's partitioning (the V2
    writer would ignore it silently; a mismatch here is an error).
    ``options`` go to the writer, e.g. ``{"maxRecordsPerFile": "5000000"}``
    to bound file sizes.
    """
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}; one of {', '.join(MODES)}")
    spark = df.sparkSession
    if staged and mode == "replace":
        restore_replaced(spark, table)
    if staged and mode == "replace" and is_v1_target(spark, table, fmt) and table_exists(spark, table):
        if staged == "pointer":
            info = describe_table(spark, table)
            if info.provider == fmt and can_point(df, info, table, partition_by):
                return _pointer_replace(df, table, info, fmt=fmt, repartition=repartition, options=options, cluster=cluster,
                                        input_partition_columns=input_partition_columns, fingerprint=fingerprint)
        return _staged_replace(df, table, fmt=fmt, partition_by=partition_by, repartition=repartition,
                               input_partition_columns=input_partition_columns, fingerprint=fingerprint,
                               options=options, cluster=cluster)
    partition_by = tuple(partition_by)
    ref = quote_ref(table)
    provider = None
    if mode == "append":
        if target_info is None and not table_exists(spark, table):
            raise ValueError(f"append target {table} does not exist")
        info = target_info or describe_table(spark, table)
        provider = info.provider
        existing = None if info.partition_columns is None else list(info.partition_columns)
        if existing is None:
            # transform-partitioned V2 table: the table's own spec places the rows
            if partition_by:
                raise ValueError(f"{table} is partitioned by transforms; append without partition_by")
        else:
            if partition_by and list(partition_by) != existing:
                raise ValueError(
                    f"append with partition_by {list(partition_by)} but {table} is partitioned by {existing}"
                )
            partition_by = tuple(existing)

    v1 = is_v1_target(spark, table, (provider or fmt) if mode == "append" else fmt)
    prepared = prepare_for_write(
        df,
        repartition=repartition,
        partition_by=partition_by,
        input_partition_columns=input_partition_columns,
        cluster=cluster if v1 else "none",
    )
    as_types = None
    if fingerprint and mode == "append":
        as_types = {f.name: f.dataType for f in spark.table(ref).schema.fields}
    observed, obs = _observed(prepared, fingerprint, as_types, partition_by if v1 else ())

    if v1:
        # V1 append must restate the table's own format and partitioning.
        writer = observed.write.options(**(options or {}))
        writer = writer.format((provider or fmt) if mode == "append" else fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.mode({"create": "errorifexists", "replace": "overwrite", "append": "append"}[mode]).saveAsTable(ref)
    else:
        writer = observed.writeTo(ref).options(**(options or {}))
        if mode != "append":
            writer = writer.using(fmt)
            if partition_by:
                writer = writer.partitionedBy(*[sql_col(c) for c in partition_by])
        if mode == "create":
            writer.create()
        elif mode == "replace":
            writer.createOrReplace()
        else:
            writer.append()

    metrics = obs.get
    rows = int(metrics.get("rows") or 0)
    fp = combine(metrics) if fingerprint else None
    return Written(table=table, mode=mode, rows=rows, fingerprint=fp, partition_by=partition_by)


def _pointer_replace(df: DataFrame, table: str, info: TableInfo, *, fmt, repartition, options, cluster, input_partition_columns, fingerprint) -> Written:
    """Write a new version of the files, then point the table at it."""
    parts = info.partition_columns
    prepared = prepare_for_write(df, repartition=repartition, partition_by=parts, input_partition_columns=input_partition_columns, cluster=cluster)
    observed, obs = _observed(prepared, fingerprint, None, parts)

    def write(rows: DataFrame, path: str) -> None:
        writer = rows.write.format(fmt).options(**(options or {}))
        (writer.partitionBy(*parts) if parts else writer).save(path)

    point_to(observed, table, info, write)
    metrics = obs.get
    return Written(table, "replace", int(metrics.get("rows") or 0), combine(metrics) if fingerprint else None, tuple(parts))


#: Set on a table while a staged replace has it aside.
REPLACED = "carryover.replaced"


def restore_replaced(spark: SparkSession, table: str) -> bool:
    """Put back the old table of a staged replace that died between its two renames.

    Only if the name has no table and there is exactly one ``name__replaced_<8 hex>`` beside it
    that the library itself put aside (its property names the same tag): no other table is taken."""
    parts = split_ref(table)
    if catalog_of(spark, table) != "spark_catalog" or table_exists(spark, table):
        return False
    parts = parts[1:] if len(parts) == 3 else parts
    space = f" IN {quote_ident(parts[-2])}" if len(parts) > 1 else ""
    if space and not spark.catalog.databaseExists(quote_ident(parts[-2])):
        return False
    left = []
    for row in spark.sql(f"SHOW TABLES{space} LIKE {sql_string(parts[-1].lower() + '__replaced_*')}").collect():
        tag = re.fullmatch(re.escape(parts[-1].lower()) + "__replaced_([0-9a-f]{8})", row["tableName"].lower())
        name = ".".join(quote_ident(p) for p in [*parts[:-1], row["tableName"]])
        if tag and _property(spark, name, REPLACED) == tag[1]:
            left.append(name)
    if len(left) != 1:
        return False
    target = ".".join(quote_ident(p) for p in parts)
    spark.sql(f"ALTER TABLE {left[0]} RENAME TO {target}")
    spark.sql(f"ALTER TABLE {target} UNSET TBLPROPERTIES IF EXISTS ({sql_string(REPLACED)})")
    return True


def _property(spark: SparkSession, ref: str, key: str) -> str | None:
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {ref}").collect()}
    return found.get(key)


def _staged_replace(df: DataFrame, table: str, **kwargs) -> Written:
    """Write beside the target, then swap by renames."""
    spark = df.sparkSession
    parts = split_ref(table)
    if len(parts) == 3 and parts[0].lower() == "spark_catalog":
        # the session catalog renames two-part names only, and those resolve in the current catalog
        if spark.catalog.currentCatalog().lower() != "spark_catalog":
            raise ValueError("staged replace needs spark_catalog as the current catalog")
        parts = parts[1:]
    tag = uuid.uuid4().hex[:8]

    def name(suffix: str) -> str:
        return ".".join(quote_ident(p) for p in parts[:-1] + [parts[-1] + suffix])

    target, staging, backup = name(""), name(f"__staging_{tag}"), name(f"__replaced_{tag}")
    try:
        written = write_table(df, staging, "create", **kwargs)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        raise
    spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ({sql_string(REPLACED)} = {sql_string(tag)})")
    spark.sql(f"ALTER TABLE {target} RENAME TO {backup}")
    try:
        spark.sql(f"ALTER TABLE {staging} RENAME TO {target}")
    except Exception:
        spark.sql(f"ALTER TABLE {backup} RENAME TO {target}")  # put the old table back
        spark.sql(f"ALTER TABLE {target} UNSET TBLPROPERTIES IF EXISTS ({sql_string(REPLACED)})")
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        raise
    try:
        spark.sql(f"DROP TABLE {backup}")
    except Exception as exc:  # noqa: BLE001 - the replace itself succeeded
        logging.getLogger(__name__).warning("replaced %s, but could not drop %s: %s", table, backup, exc)
    written.table, written.mode = table, "replace"
    return written


def load_overwrite(df: DataFrame, table: str, max_rows: int = 0, *, fmt: str = "parquet") -> int:
    """K6: (re)load a table with overwrite, creating its database first; returns the table's rows.

    Mirrors the staging loader: optional row cap (T3), overwrite, recount.  A table that is there is
    replaced with its old rows kept until the new ones are written (``staged="pointer"``), so a failed load loses nothing.
    """
    from .transforms import limit_rows

    spark = df.sparkSession
    ns = namespace_of(table)
    if ns:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns}")
    mode = "replace" if table_exists(spark, table) else "create"
    write_table(limit_rows(df, max_rows), table, mode, fmt=fmt, staged="pointer")
    return int(spark.table(quote_ref(table)).count())


@dataclass
class Exported:
    path: str
    rows: int
    partitions: DataFrame  # partition columns + n_rows written by this export


def export_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    *,
    mode: str = "append",
    max_records_per_file: int | None = None,
    input_partition_columns: Sequence[str] | None = None,
    verify: bool = False,
    cluster: str = "rebalance",
) -> Exported:
    """K7 + A3: write Hive-style ``col=value/`` Parquet directories.

    The partition columns live only in the directory names.  ``append`` is
    the reference's mode, so re-running an export adds the rows again;
    ``overwrite`` replaces just the partitions present in ``df`` (dynamic
    partition overwrite), so a re-run is idempotent and leaves the other
    partitions of the tree alone.

    ``rows`` is counted by the write itself.  Rows per partition (A3) are a
    ``groupBy(partition columns).count()`` over the exported DataFrame:
    Parquet reads only the columns the partition values derive from (none
    for a literal ``ds``), each task pre-aggregates to one row per value,
    and the cost follows the size of this export, not the history already
    in the target tree.  ``verify=True`` runs it at once and checks that it
    sums to the written total (a source that changed between the two reads
    is an error).
    """
    if not partition_by:
        raise ValueError("partition_by must name at least one column")
    if mode not in ("append", "overwrite", "errorifexists"):
        raise ValueError(f"unsupported export mode {mode!r}")
    cols = list(partition_by)

    prepared = prepare_for_write(df, partition_by=cols, input_partition_columns=input_partition_columns, cluster=cluster)
    observed, obs = _observed(prepared, fingerprint=False)
    writer = observed.write.mode(mode).partitionBy(*cols)
    if mode == "overwrite":
        # replace only the partitions this export writes; the rest of the tree stays
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(int(max_records_per_file)))
    writer.parquet(path)
    rows = int(obs.get.get("rows") or 0)

    per_part = df.groupBy(*[F.col(quote_ident(c)) for c in cols]).agg(F.count(F.lit(1)).alias("n_rows"))
    if verify:
        total = per_part.agg(F.sum("n_rows")).first()[0] or 0
        if int(total) != rows:
            raise RuntimeError(f"export wrote {rows} rows but the input now has {total}")
    return Exported(path=path, rows=rows, partitions=per_part)
