"""Shaping a DataFrame before it is written.

All of these are lazy DataFrame transformations; none runs a job.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import sql_col


CLUSTER = ("rebalance", "none")
# Marks a column whose few values the caller named (tag_partition, replicate_partitions).
KNOWN_VALUES = "carryover.known_values"


def _known_values(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether every column can hold only values the caller named."""
    fields = {f.name.lower(): f for f in df.schema.fields}
    return all(c.lower() in fields and KNOWN_VALUES in (fields[c.lower()].metadata or {}) for c in columns)


def _aqe_enabled(df: DataFrame) -> bool:
    return str(df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true")).lower() == "true"


def prepare_for_write(
    df: DataFrame,
    *,
    repartition: int | str | None = None,
    partition_by: Sequence[str] = (),
    input_partition_columns: Sequence[str] | None = None,
    cluster: str = "rebalance",
) -> DataFrame:
    """T1 plus clustering of a partitioned write.

    * ``repartition=n`` (n > 0): exactly what was asked, round-robin into
      ``n`` tasks, hence up to ``n`` files per partition value.  0 or
      ``None`` means "leave it to Spark", as in the reference.
    * ``repartition="auto"``: compaction without choosing ``n`` — a
      ``REBALANCE`` (on the partition columns, if any) whose output
      partitions AQE sizes to ``spark.sql.adaptive.advisoryPartitionSizeInBytes``;
      many small input files become few files of that size.
    * partitioned write whose input is already split along the same
      columns (every input file lies inside one target partition, i.e. the
      target's columns are a subset of the input's): no shuffle at all.
    * ``cluster="none"``, or columns whose few values the caller named
      (:func:`tag_partition`, :func:`replicate_partitions`): no shuffle; a task
      writes one file per value it meets.  For a column of few values over
      large files that beats moving every row.
    * other partitioned writes: a ``REBALANCE`` on the partition columns.
      Without it every task writes one file per value it meets (tasks ×
      values small files).  With AQE on, rebalance both merges small
      shuffle partitions and *splits* a hot value that holds a large share
      of the rows over several tasks, so one skewed day does not become one
      straggler task.  With AQE off the hint would be a plain hash
      exchange, skew included, so it is not used then.
    """
    if repartition == "auto":
        # compaction without guessing n: AQE sizes the output partitions (and so the files)
        if not _aqe_enabled(df):
            raise ValueError("repartition='auto' needs spark.sql.adaptive.enabled=true; give a number instead")
        if partition_by:
            return df.hint("rebalance", *[sql_col(c) for c in partition_by])
        return df.hint("rebalance")
    if repartition:
        if int(repartition) < 0:
            raise ValueError("repartition must be positive")
        return df.repartition(int(repartition))
    if not partition_by:
        return df
    if cluster not in CLUSTER:
        raise ValueError(f"unknown cluster {cluster!r}; one of {', '.join(CLUSTER)}")
    if cluster == "none" or _known_values(df, partition_by):
        return df
    if input_partition_columns is not None and set(partition_by) <= set(input_partition_columns):
        return df
    if _aqe_enabled(df):
        return df.hint("rebalance", *[sql_col(c) for c in partition_by])
    return df


#: Files named in the filter of a parallel cap; a cap that keeps more files is joined to them.
MOST_FILES = 10_000


def limit_rows(df: DataFrame, max_rows: int, order_by: Sequence[str | Column] | None = None, *, parallel: bool = False) -> DataFrame:
    """At most ``max_rows`` rows; 0 keeps all.

    A plain limit keeps *some* rows (which ones is not defined, and may
    differ between runs), and all of them pass one task.  Give ``order_by`` for a
    repeatable cap: Spark then plans a top-k (each task keeps its best ``max_rows``, one task
    merges them), never a full sort.

    ``parallel=True`` caps a plain read of Parquet files without that one task: a count of
    the rows of each file (footers only), their running sum, and each file's quota; files
    in the order of their names are kept whole until the cap, of the last one its first
    rows, the others are not opened.  Exactly ``max_rows`` rows, the same ones each time, in as many tasks
    as their files have.  Anything but a read (filters, joins, other formats) gets the plain limit.
    """
    if max_rows < 0:
        raise ValueError("max_rows must be >= 0")
    if max_rows == 0:
        return df
    if order_by:
        return df.orderBy(*order_by).limit(int(max_rows))
    if parallel and _plain_parquet(df):
        return _first_files(df, int(max_rows))
    return df.limit(int(max_rows))


def _plain_parquet(df: DataFrame) -> bool:
    """Whether ``df`` is a read of Parquet files, with or without some of its columns."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() == "Project" and all(plan.projectList().apply(i).nodeName() == "AttributeReference" for i in range(plan.projectList().size())):
        plan = plan.child()
    return plan.nodeName().startswith("LogicalRelation") and plan.toString().strip().endswith("parquet")


def _first_files(df: DataFrame, max_rows: int) -> DataFrame:
    counts = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1))  # one row a file
    kept = counts.withColumn("quota", F.lit(max_rows) - F.coalesce(before, F.lit(0))).where("quota > 0")
    path, at = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    named = kept.limit(MOST_FILES + 1).collect()
    if len(named) > MOST_FILES:
        row = df.select("*", path.alias("__path"), at.alias("__at")).join(kept.select(F.col("path").alias("__path"), "quota"), "__path")
        return row.where("__at < quota").select(*[sql_col(c) for c in df.columns])
    last = [r for r in named if r["quota"] < r["n"]]
    out = df.where(path.isin([r["path"] for r in named]))
    for r in last:  # one file at most
        out = out.where((path != r["path"]) | (at < r["quota"]))
    return out


def tag_partition(df: DataFrame, column: str, value: object) -> DataFrame:
    """T4: add (or replace) a constant column, e.g. ``ds = '2024-01-15'``."""
    return df.withColumn(column, F.lit(value)).withMetadata(column, {KNOWN_VALUES: 1})


def replicate_partitions(df: DataFrame, column: str, values: Iterable[object]) -> DataFrame:
    """T5: every input row once per value of ``column``.

    The reference loops over the values and writes the input once per value
    (k scans, k jobs).  Here it is one scan: each row is expanded in place
    by ``explode`` over a literal array, no join and no shuffle; the values
    are the caller's short literal list.
    """
    vals = list(values)
    if not vals:
        raise ValueError("values must not be empty")
    return df.withColumn(column, F.explode(F.array(*[F.lit(v) for v in vals]))).withMetadata(column, {KNOWN_VALUES: len(vals)})
