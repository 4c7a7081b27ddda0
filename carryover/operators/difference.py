"""V6: which rows differ between two tables, descending only into what is unequal.

Comparing two tables row by row (``exceptAll``) shuffles both whole.  Here both sides are
reduced to fingerprints first (counts and exact sums of row hashes, pre-aggregated by each task):

1. *partitions*, where columns are named: equal ones are not read again;
2. *buckets* of the row hash: ``BUCKETS`` groups a side;
3. *buckets of the buckets* that are unequal: ``BUCKETS`` more for each.

Only rows of unequal small buckets are then compared exactly, by ``exceptAll`` in both
directions, so what is shuffled is in proportion to the difference (a changed row
brings about ``rows / BUCKETS**2`` others along).  A bucket whose rows differ but whose
counts and 64-bit sums agree would be missed; nothing else can be.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import sql_col
from .validate import _hashable, _slice_sums

BUCKETS = 4096
#: Unequal partitions that are named in a filter, so that the others are pruned; beyond, a semi-join does it.
MOST_NAMED = 1000
_SUMS = ["n", "_h_hi", "_h_mid", "_h_lo"]


def _unequal(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """The groups ``by`` whose fingerprints differ; both sides have the row hash ``_h``."""
    both = left.select(*map(sql_col, by), "_h", F.lit(1).alias("_side")).unionByName(right.select(*map(sql_col, by), "_h", F.lit(-1).alias("_side")))
    # one row a group, task and side goes into the shuffle; equal sides cancel out
    sided = both.groupBy(*map(sql_col, by), "_side").agg(F.count("*").alias("n"), *_slice_sums(F.col("_h")))
    summed = sided.groupBy(*map(sql_col, by)).agg(*[F.sum(F.col(c) * F.col("_side")).alias(c) for c in _SUMS])
    return summed.where(reduce(lambda a, b: a | b, (F.col(c) != 0 for c in _SUMS))).select(*map(sql_col, by))


def _hashed(df: DataFrame, columns: list[str]) -> DataFrame:
    h = F.xxhash64(*[_hashable(df, c) for c in sorted(columns)])
    return df.select(*map(sql_col, columns), h.alias("_h")).withColumns(
        {"_b1": F.pmod("_h", F.lit(BUCKETS)).cast("int"), "_b2": F.pmod(F.shiftright("_h", 24), F.lit(BUCKETS)).cast("int")}
    )


def _only(df: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows of ``df`` in the groups; nulls are values."""
    named = groups.select(*[sql_col(c).alias(f"_g{i}") for i, c in enumerate(by)])
    same: Column = reduce(lambda a, b: a & b, (sql_col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)))
    return df.join(named, same, "left_semi")


def rows_not_in(few: DataFrame, many: DataFrame) -> DataFrame:
    """``few.exceptAll(many)`` where ``few`` holds a bounded number of rows, such as a capped read.

    ``few`` is broadcast, and of ``many`` only the rows equal to one of its rows are grouped: no task holds
    more different rows than ``few`` has, and ``many`` is not shuffled.
    """
    return few.exceptAll(_only(many.select(*map(sql_col, few.columns)), F.broadcast(few), few.columns))


def difference(left: DataFrame, right: DataFrame, partition_columns: Sequence[str] = ()) -> DataFrame:
    """``side`` (``left`` or ``right``) and the columns of ``left``: rows one side has more often
    than the other, as often as it has them more.

    Both sides need the same columns and types; maps cannot be compared.  Rows with nulls compare as values.
    """
    columns, by = list(left.columns), list(partition_columns)
    if sorted(columns) != sorted(right.columns):
        raise ValueError(f"columns differ: {sorted(set(columns) ^ set(right.columns))}")
    right = right.select(*map(sql_col, columns))
    sides = [left, right]
    if by:
        groups = _unequal(*(_hashed(s, columns) for s in sides), by)
        found = groups.limit(MOST_NAMED + 1).collect()
        if len(found) <= MOST_NAMED:
            named = [reduce(lambda a, b: a & b, (sql_col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, row))) for row in found]
            sides = [s.where(reduce(lambda a, b: a | b, named, F.lit(False))) for s in sides]
        else:
            sides = [_only(s, groups, by) for s in sides]
    hashed = [_hashed(s, columns) for s in sides]
    first = [r[0] for r in _unequal(*hashed, ["_b1"]).collect()]  # at most BUCKETS numbers
    hashed = [h.where(F.col("_b1").isin(first)) if first else h.limit(0) for h in hashed]
    groups = _unequal(*hashed, ["_b1", "_b2"])
    rest = [_only(h, groups, ["_b1", "_b2"]).select(*map(sql_col, columns)) for h in hashed]
    out = [a.exceptAll(b).select(F.lit(side).alias("side"), *map(sql_col, columns)) for side, a, b in (("left", *rest), ("right", *rest[::-1]))]
    return out[0].unionByName(out[1])
