"""Per-file statistics (rows, min, max, null count) and their roll-up per partition.

The reference leaves file statistics to the table format (footer
metadata).  Here they are computed by Spark from the files themselves,
grouped on the hidden ``_metadata.file_path`` column.  Each input split
belongs to one file, so the partial aggregation in every task already
collapses its rows to one row per file: the shuffle carries one small
row per (task, file), never rows of data.  Only the named columns are
read (column pruning), and a file is at most one split's worth of rows
per task, so no group can grow with the data's skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import sql_col


def file_stats(df: DataFrame, columns: Sequence[str], partition_columns: Sequence[str] = ()) -> DataFrame:
    """One row per data file: ``file_path``, partition values, ``n_rows``,
    and ``min_<c>``, ``max_<c>``, ``nulls_<c>`` for each column ``c``.

    ``df`` must be a direct file scan (``spark.read.parquet`` or a file
    table), since it reads the hidden ``_metadata`` column.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        aggs += [
            F.min(sql_col(c)).alias(f"min_{c}"),
            F.max(sql_col(c)).alias(f"max_{c}"),
            F.count_if(sql_col(c).isNull()).alias(f"nulls_{c}"),
        ]
    keys = [F.col("_metadata.file_path").alias("file_path")] + [sql_col(p) for p in partition_columns]
    return df.groupBy(*keys).agg(*aggs)


def partition_stats(df: DataFrame, columns: Sequence[str], partition_columns: Sequence[str]) -> DataFrame:
    """Roll file statistics up per partition: ``n_files``, ``n_rows`` and the same per-column fields."""
    per_file = file_stats(df, columns, partition_columns)
    aggs = [F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows")]
    for c in columns:
        aggs += [
            F.min(sql_col(f"min_{c}")).alias(f"min_{c}"),
            F.max(sql_col(f"max_{c}")).alias(f"max_{c}"),
            F.sum(sql_col(f"nulls_{c}")).alias(f"nulls_{c}"),
        ]
    return per_file.groupBy(*[sql_col(p) for p in partition_columns]).agg(*aggs)
