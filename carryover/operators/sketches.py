"""Statistics per partition that merge, kept in a table that a load only adds to.

One row per (load, partition): rows, and for each column minimum, maximum, NULLs, a
distinct-count sketch (HyperLogLog) and, for number columns asked for, a quantile
sketch (KLL).  All of these merge, so a load scans only what it brings, and
coarser questions (per month, whole table) are answered from the rows of
finer ones without reading data.  Counts, extremes and NULLs are
exact; distinct counts have a relative standard error of 1.04 / 2**(lg_k / 2) (1.6 % at
the default 12); quantiles a rank error below 1.7 % (99 % confidence, k = 200).

Sketches are built by partial aggregation: a task sends one row per
partition it meets (a few KB), whatever a hot partition holds.  Nothing
reaches the driver.

A load that replaced its partitions (``resets=True``) hides what earlier loads
said of them.  :func:`compact_statistics` brings the table back to one row a partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import quote_ref, sql_col
from .write import table_exists, write_table

LG_K = 12
KLL_K = 200
_DIRECT = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def _hashable(name: str, kind: T.DataType) -> Column:
    """The column in a type that the distinct sketch takes; equal values stay equal."""
    value = sql_col(name)
    if isinstance(kind, _DIRECT):
        return value
    if isinstance(kind, (T.ByteType, T.ShortType)):
        return value.cast("int")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (value + F.lit(0.0)).cast("string")  # -0.0 is 0.0
    return value.cast("string")


def partition_sketches(
    df: DataFrame, columns: Sequence[str], partition_columns: Sequence[str] = (), quantiles: Sequence[str] = ()
) -> DataFrame:
    """One row per partition: ``n_rows`` and per column ``min_ max_ nulls_ distinct_`` (and ``quantiles_``).

    ``distinct_`` and ``quantiles_`` are sketches; :func:`merge_sketches` joins
    rows, :func:`estimates` turns sketches into numbers.  ``quantiles``: number
    columns among ``columns``.  One pass over the named columns.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    odd = [c for c in quantiles if c not in columns or not isinstance(kinds[c], T.NumericType)]
    if odd:
        raise ValueError(f"quantiles need number columns of the list: {', '.join(odd)}")
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        aggs += [
            F.min(sql_col(c)).alias(f"min_{c}"),
            F.max(sql_col(c)).alias(f"max_{c}"),
            F.count_if(sql_col(c).isNull()).alias(f"nulls_{c}"),
            F.hll_sketch_agg(_hashable(c, kinds[c]), LG_K).alias(f"distinct_{c}"),
        ]
        if c in quantiles:
            aggs.append(F.kll_sketch_agg_double(sql_col(c).cast("double"), KLL_K).alias(f"quantiles_{c}"))
    return df.groupBy(*[sql_col(p) for p in partition_columns]).agg(*aggs)


def _column_names(stats: DataFrame) -> tuple[list[str], set[str]]:
    names = [c[len("nulls_"):] for c in stats.columns if c.startswith("nulls_")]
    return names, {c for c in names if f"quantiles_{c}" in stats.columns}


def merge_sketches(stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of :func:`partition_sketches` joined per ``by`` (any of its partition columns, or none: all)."""
    names, quantiles = _column_names(stats)
    aggs = [F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")]
    for c in names:
        aggs += [
            F.min(sql_col(f"min_{c}")).alias(f"min_{c}"),
            F.max(sql_col(f"max_{c}")).alias(f"max_{c}"),
            F.coalesce(F.sum(sql_col(f"nulls_{c}")), F.lit(0)).alias(f"nulls_{c}"),
            F.hll_union_agg(sql_col(f"distinct_{c}")).alias(f"distinct_{c}"),
        ]
        if c in quantiles:
            aggs.append(F.kll_merge_agg_double(sql_col(f"quantiles_{c}")).alias(f"quantiles_{c}"))
    return stats.groupBy(*[sql_col(p) for p in by]).agg(*aggs)


def estimates(stats: DataFrame, ranks: Sequence[float] = (0.5,)) -> DataFrame:
    """Sketches as numbers: ``distinct_<c>`` a count, ``quantiles_<c>`` an array, one value a rank (NULL without values)."""
    names, quantiles = _column_names(stats)
    out = stats
    for c in names:
        out = out.withColumn(f"distinct_{c}", F.hll_sketch_estimate(sql_col(f"distinct_{c}")))
        if c in quantiles:
            sketch = sql_col(f"quantiles_{c}")
            held = F.kll_sketch_get_n_double(sketch) > 0
            found = F.array(*[F.kll_sketch_get_quantile_double(sketch, F.lit(float(r))) for r in ranks])
            out = out.withColumn(f"quantiles_{c}", F.when(held, found))
    return out


def record_statistics(
    df: DataFrame,
    stats_table: str,
    columns: Sequence[str],
    partition_columns: Sequence[str],
    *,
    quantiles: Sequence[str] = (),
    resets: bool = False,
) -> None:
    """Add what one load brought (``df``) to ``stats_table``, which is made if missing.

    ``resets``: the load replaced its partitions, so earlier rows of them no longer count.
    """
    spark = df.sparkSession
    there = table_exists(spark, stats_table)
    last = spark.table(quote_ref(stats_table)).agg(F.max("load_seq")).first()[0] if there else None
    rows = partition_sketches(df, columns, partition_columns, quantiles)
    rows = rows.withColumn("load_seq", F.lit((last or 0) + 1).cast("bigint")).withColumn("resets", F.lit(resets))
    write_table(rows, stats_table, "append" if there else "create")


def current_sketches(spark: SparkSession, stats_table: str, partition_columns: Sequence[str]) -> DataFrame:
    """The rows of ``stats_table`` that count: of each partition, those since its last reset."""
    rows = spark.table(quote_ref(stats_table))
    same = Window.partitionBy(*[sql_col(p) for p in partition_columns])
    reset = F.max(F.when(F.col("resets"), F.col("load_seq"))).over(same)
    return rows.withColumn("__reset", reset).where("__reset IS NULL OR load_seq >= __reset").drop("__reset")


def read_statistics(
    spark: SparkSession,
    stats_table: str,
    partition_columns: Sequence[str],
    by: Sequence[str] | None = None,
    ranks: Sequence[float] = (0.5,),
) -> DataFrame:
    """Statistics per ``by`` (default: per partition; ``[]``: of the whole table), no data read."""
    current = current_sketches(spark, stats_table, partition_columns)
    return estimates(merge_sketches(current, partition_columns if by is None else by), ranks)


def compact_statistics(spark: SparkSession, stats_table: str, partition_columns: Sequence[str]) -> None:
    """One row per partition again; answers stay as they were (sketches merge to what they would be merged to)."""
    current = current_sketches(spark, stats_table, partition_columns)
    last = spark.table(quote_ref(stats_table)).agg(F.max("load_seq")).first()[0]
    merged = merge_sketches(current, partition_columns)
    rows = merged.withColumn("load_seq", F.lit(last).cast("bigint")).withColumn("resets", F.lit(False))
    write_table(rows.select(*spark.table(quote_ref(stats_table)).columns), stats_table, "replace")
