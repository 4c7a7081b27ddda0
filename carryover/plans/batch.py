"""Migrate one table, or many with failures isolated, and report as a DataFrame.

Per table (O1): validate the options first, resolve names, read lazily,
write (one scan of the source, counted by an ``Observation`` on the
write), recount the target, compare (V6).  ``target_rows`` is always the
whole table (footers).  A content check of an append reads only the
partitions the append touches.  Registration takes the
metadata path of :mod:`carryover.operators.register`.

Across tables (O2): target names are derived for all tables first and a
collision (two sources, one target) fails those tables before anything is
written.  One failing table is recorded and the rest go on.  With
``parallelism > 1`` the tables are submitted from driver threads, so
their Spark jobs share the cluster (use the FAIR scheduler to interleave
them); each thread only submits jobs, all data work stays on executors.
A table may have a deadline (its jobs are cancelled by their tag, the others
go on) and be tried again after an error that may pass; ``longest_first`` submits
the largest inputs first, so that the batch does not end waiting for one of them.
The report is one row per table.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.names import quote_ident, quote_ref, split_ref
from ..jobs import DeadlineExceeded, deadline, labelled, may_pass
from ..operators.register import infer_layout, register_files
from ..operators.validate import compare, fingerprint, fingerprint_pair, subtract_fingerprint
from ..operators.transforms import CLUSTER
from ..operators.write import (
    describe_table,
    ensure_namespace,
    is_v1_target,
    table_exists,
    table_partition_columns,
    write_table,
)
from ..sources.base import Source
from ..sources.catalog import CatalogSource
from ..sources.parquet import ParquetSource, read_parquet

WRITE_MODES = ("create", "replace", "append", "register")
VERIFY = ("count", "content")

REPORT_SCHEMA = StructType(
    [
        StructField("source", StringType(), False),
        StructField("target", StringType(), True),
        StructField("mode", StringType(), False),
        StructField("source_rows", LongType(), True),
        StructField("target_rows", LongType(), True),
        StructField("added_rows", LongType(), True),
        StructField("status", StringType(), False),
        StructField("error", StringType(), True),
    ]
)


@dataclass(frozen=True)
class MigrationOptions:
    """What to do with every table of a batch (the reference's ``migration`` + ``target`` blocks)."""

    mode: str = "create"
    catalog: str = "spark_catalog"
    database: str = "default"
    fmt: str = "parquet"
    repartition: int | str | None = None  # n, or "auto" (AQE-sized rebalance)
    partition_by: tuple[str, ...] = ()
    register_partition_columns: tuple[str, ...] | None = None
    verify: str = "count"
    writer_options: Mapping[str, str] = field(default_factory=dict)
    staged_replace: bool = True  # session-catalog replace through a staging table (see write_table)
    incremental: bool = False  # register: tell the catalog only what changed (see register_files)
    cluster: str = "rebalance"  # partitioned writes: "rebalance" (few files) or "none" (no shuffle)

    def validate(self) -> None:
        """Reject bad options before any read or write (reference fault: found after the count)."""
        if self.mode not in WRITE_MODES:
            raise ValueError(f"unknown write mode {self.mode!r}; one of {', '.join(WRITE_MODES)}")
        if self.verify not in VERIFY:
            raise ValueError(f"unknown verify {self.verify!r}; one of {', '.join(VERIFY)}")
        if self.repartition is not None and self.repartition != "auto":
            if not isinstance(self.repartition, int) or self.repartition < 0:
                raise ValueError("repartition must be a number >= 0 or 'auto'")
        if self.cluster not in CLUSTER:
            raise ValueError(f"unknown cluster {self.cluster!r}; one of {', '.join(CLUSTER)}")
        if self.mode == "register" and (self.repartition or self.partition_by):
            raise ValueError("register rewrites nothing: repartition / partition_by do not apply")

    def target(self, name: str) -> str:
        return ".".join(quote_ident(p) for p in (self.catalog, self.database, name))


def select_tables(configured: Sequence[str], requested: str | Sequence[str] | None) -> list[str]:
    """O3: the tables to run — the requested subset (``"a,b"`` or a list) or all configured.

    Empty names (``"a,,b"``) are dropped.
    """
    if requested:
        items = requested.split(",") if isinstance(requested, str) else list(requested)
        return [t.strip() for t in items if t and t.strip()]
    return [t for t in configured if t and t.strip()]


def _source_partition_columns(spark: SparkSession, source: Source, ref: str) -> list[str] | None:
    if isinstance(source, CatalogSource):
        return table_partition_columns(spark, source.resolve(ref))
    if isinstance(source, ParquetSource) and source.reconcile:
        return None  # read as one plan per layout; asking mergeSchema could fail
    if isinstance(source, ParquetSource):
        return list(infer_layout(spark, ref, merge_schema=source.merge_schema).partition_columns)
    return None


def touched_rows(df: DataFrame, table: DataFrame, partition_columns: Sequence[str], blank_is_null: bool = True) -> DataFrame:
    """The rows of ``table`` in the partitions (by its outermost column) that ``df`` has values for.

    A left-semi join on the distinct incoming values, cast to the table's type
    (never the reverse), so Spark picks the join by size and prunes the
    table's directories at run time; nothing is collected.  Names match as
    Spark matches them, whatever their case.  ``df`` without the column, or a
    table without plain partition columns: all rows.
    """
    names = {c.lower(): c for c in df.columns}
    if not partition_columns or partition_columns[0].lower() not in names:
        return table
    column = partition_columns[0]
    kind = next(f.dataType for f in table.schema.fields if f.name.lower() == column.lower())
    value = F.col(quote_ident(names[column.lower()])).cast(kind)
    if blank_is_null:  # a file table keeps NULL and '' in one default partition and reads both as NULL
        value = F.when(value.cast("string") == "", None).otherwise(value)
    values = df.select(value.alias("__touched")).distinct()
    return table.join(values, table[quote_ident(column)].eqNullSafe(values["__touched"]), "left_semi")


def migrate_table(
    spark: SparkSession,
    source: Source,
    ref: str,
    options: MigrationOptions,
    target_name: str | None = None,
) -> dict[str, object]:
    """O1: one table; returns its report row as a dict (raises on failure)."""
    options.validate()
    name = target_name or source.target_name(ref)
    target = options.target(name)
    namespace = ".".join(quote_ident(p) for p in (options.catalog, options.database))

    if options.mode == "register":
        if not isinstance(source, ParquetSource):
            raise ValueError("register needs Parquet paths, not catalog tables")
        if source.reconcile:
            raise ValueError("register rewrites nothing: files of different types cannot be one table; copy them")
        reg = register_files(
            spark,
            ref,
            target,
            partition_columns=options.register_partition_columns,
            merge_schema=source.merge_schema,
            fmt=None if options.catalog == "spark_catalog" else options.fmt,
            incremental=options.incremental,
        )
        status, error = compare(reg.source_rows, reg.compared_rows)
        if options.verify == "content" and status == "success" and not (reg.adds and reg.rows_before):
            files = reg.files if reg.files is not None else read_parquet(spark, ref, merge_schema=source.merge_schema)
            fp_files, fp_table = fingerprint_pair(files, spark.table(target), files.columns)
            status, error = compare(reg.source_rows, reg.target_rows, fp_files, fp_table)
        return {
            "source": ref,
            "target": target,
            "mode": "register",
            "source_rows": reg.source_rows,
            "target_rows": reg.target_rows,
            "added_rows": reg.target_rows - reg.rows_before,
            "status": status,
            "error": error,
        }

    df = source.read(spark, ref)  # resolves the source before anything is created
    ensure_namespace(spark, namespace)
    content = options.verify == "content"
    exists = options.mode == "append" and table_exists(spark, target)
    info = describe_table(spark, target) if exists else None
    target_parts = list(info.partition_columns or ()) if info else []
    file_table = bool(info) and is_v1_target(spark, target, info.provider or options.fmt)
    # Only a partitioned write needs to know how the source is split.
    target_partitioned = bool(target_parts) if options.mode == "append" else bool(options.partition_by)

    def touched() -> DataFrame:
        return touched_rows(df, spark.table(target), target_parts, blank_is_null=file_table)

    rows_before = 0
    fp_before = None
    if exists:
        rows_before = int(spark.table(target).count())
        if content:
            fp_before = fingerprint(touched(), df.columns)

    written = write_table(
        df,
        target,
        options.mode,
        fmt=options.fmt,
        partition_by=options.partition_by,
        repartition=options.repartition,
        input_partition_columns=(
            _source_partition_columns(spark, source, ref) if target_partitioned else None
        ),
        fingerprint=content,
        options=dict(options.writer_options),
        target_info=info,
        staged=options.staged_replace,
        cluster=options.cluster,
    )
    if content:
        fp_after = fingerprint(touched() if exists else spark.table(target), df.columns)
        added = subtract_fingerprint(fp_after, fp_before)
        status, error = compare(written.rows, int(added["rows"]), written.fingerprint, added)  # type: ignore[arg-type]
    target_rows = int(spark.table(target).count())
    if not content or status == "success":
        status, error = compare(written.rows, target_rows - rows_before)
    return {
        "source": ref,
        "target": target,
        "mode": options.mode,
        "source_rows": written.rows,
        "target_rows": target_rows,
        "added_rows": target_rows - rows_before,
        "status": status,
        "error": error,
    }


def _failed(ref: str, target: str | None, mode: str, exc: BaseException | str) -> dict[str, object]:
    text = exc if isinstance(exc, str) else str(exc).strip() or type(exc).__name__
    return {
        "source": ref,
        "target": target,
        "mode": mode,
        "source_rows": None,
        "target_rows": None,
        "added_rows": None,
        "status": "failed",
        "error": text,
    }


def plan_targets(
    source: Source, refs: Sequence[str], options: MigrationOptions, targets: Mapping[str, str] | None = None
) -> list[tuple[str, str | BaseException]]:
    """Target table per ref, in input order, or the error that stops that ref.

    Errors: a name that cannot be a table, a ref listed more than once (its
    repeats fail, the first runs), and two different refs sharing a target
    (all of them fail) — all found before anything is written.
    """
    planned: list[tuple[str, str | BaseException]] = []
    seen: set[str] = set()
    for ref in refs:
        if ref in seen:
            planned.append((ref, ValueError(f"{ref} is listed more than once")))
            continue
        seen.add(ref)
        try:
            planned.append((ref, options.target((targets or {}).get(ref) or source.target_name(ref))))
        except Exception as exc:  # noqa: BLE001
            planned.append((ref, exc))
    by_target: dict[str, list[str]] = {}
    for ref, t in planned:
        if isinstance(t, str):
            by_target.setdefault(split_ref(t)[-1].lower(), []).append(ref)
    out: list[tuple[str, str | BaseException]] = []
    for ref, t in planned:
        if isinstance(t, str) and len(by_target[split_ref(t)[-1].lower()]) > 1:
            others = [r for r in by_target[split_ref(t)[-1].lower()] if r != ref]
            t = ValueError(f"target {t} is shared with {', '.join(others)}")
        out.append((ref, t))
    return out


def input_bytes(spark: SparkSession, source: Source, ref: str) -> int:
    """Spark's estimate of a ref's size (file sizes, or the catalog's statistics); 0 if it cannot be read."""
    try:
        plan = source.read(spark, ref)._jdf.queryExecution().optimizedPlan()
        return int(str(plan.stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - the table's own try reports what is wrong with it
        return 0


def _tried(
    spark: SparkSession, source: Source, ref: str, options: MigrationOptions, target: str, retries: int
) -> dict[str, object]:
    """One table, tried again after errors that may pass.  A failed create leaves no table of its own."""
    own = options.mode == "create" and not table_exists(spark, target)
    wait = 1.0
    while True:
        try:
            return migrate_table(spark, source, ref, options, target_name=split_ref(target)[-1])
        except Exception as exc:
            if own and "ALREADY_EXISTS" not in str(exc):  # else another session made it meanwhile
                spark.sql(f"DROP TABLE IF EXISTS {quote_ref(target)}")
            if retries <= 0 or options.mode == "append" or not may_pass(exc):
                raise
        retries -= 1
        time.sleep(wait)
        wait *= 2


def _timed_out(spark: SparkSession, ref: str, target: str, mode: str, exc: DeadlineExceeded) -> dict[str, object]:
    row = _failed(ref, target, mode, exc) | {"status": "timed out"}
    if mode in ("append", "replace") and table_exists(spark, target):
        row["target_rows"] = int(spark.table(quote_ref(target)).count())
    return row


def run_migration(
    spark: SparkSession,
    source: Source,
    refs: Sequence[str],
    options: MigrationOptions,
    *,
    targets: Mapping[str, str] | None = None,
    parallelism: int = 1,
    scheduler_pool: str | None = None,
    timeout: float | Mapping[str, float] | None = None,
    retries: int = 0,
    longest_first: bool = False,
) -> DataFrame:
    """O2: migrate every ref; one row per ref in the report, in input order.

    ``parallelism`` tables are in flight at once (driver threads submitting
    jobs); ``scheduler_pool`` names the FAIR pool their jobs run in.

    ``timeout``: seconds a table may take (one number, or one per ref), all its tries
    together.  A table cancelled for it has status ``timed out``; a create leaves no
    table behind.  If an append or replace had landed before its check was cancelled,
    ``target_rows`` says what is there.  ``retries``: further tries after an error that may pass
    (:func:`carryover.jobs.may_pass`), each after twice the wait; an
    append is never tried twice (use ``append_once``).  ``longest_first``: submit by
    size of input, largest first (Spark's estimate: file sizes).
    """
    options.validate()
    if retries < 0:
        raise ValueError("retries must be >= 0")
    refs = [r for r in refs if r and r.strip()]
    planned = plan_targets(source, refs, options, targets)
    limits = timeout if isinstance(timeout, Mapping) else dict.fromkeys(refs, timeout)

    def one(item: tuple[str, str | BaseException]) -> dict[str, object]:
        ref, t = item
        if isinstance(t, BaseException):
            return _failed(ref, None, options.mode, t)
        try:
            with labelled(spark, f"carryover {options.mode} {ref} -> {t}", scheduler_pool):
                with deadline(spark, limits.get(ref)):
                    return _tried(spark, source, ref, options, t, retries)
        except DeadlineExceeded as exc:
            return _timed_out(spark, ref, t, options.mode, exc)
        except Exception as exc:  # noqa: BLE001 - isolate the failure, go on with the rest
            return _failed(ref, t, options.mode, exc)

    order = list(range(len(planned)))
    if longest_first:
        sizes = [input_bytes(spark, source, ref) if isinstance(t, str) else 0 for ref, t in planned]
        order.sort(key=lambda i: -sizes[i])
    if parallelism > 1 and len(planned) > 1:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            done = list(pool.map(one, [planned[i] for i in order]))
    else:
        done = [one(planned[i]) for i in order]
    rows = [row for _, row in sorted(zip(order, done), key=lambda p: p[0])]
    return spark.createDataFrame([tuple(r[f.name] for f in REPORT_SCHEMA.fields) for r in rows], REPORT_SCHEMA)


def summarize(report: DataFrame) -> DataFrame:
    """Tables and rows per status."""
    return report.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_tables"),
        F.coalesce(F.sum("source_rows"), F.lit(0)).cast("bigint").alias("source_rows"),
    )
