"""V6, A1, A2: counts and an additive content fingerprint.

The count of what was written comes from an ``Observation`` on the write
itself, so the source is read once and the number describes exactly the
rows that went into the files (the reference counted in a second scan).

The fingerprint is ``(rows, sum of a 64-bit row hash)``: one aggregation
per side, partial per task then a single-row merge, no shuffle of rows
(``exceptAll`` would shuffle both tables whole).  Because it is a sum it
is additive: ``fp(after) - fp(before) == fp(appended)``, which lets an
append be checked too.  Duplicated rows count twice, so a lost or doubled
row changes it.  The sum is computed exactly with ``bigint`` arithmetic
only: each hash is cut into three slices (high 22 bits signed, then two
21-bit slices), each slice is summed, and the driver recombines
``hi * 2^42 + mid * 2^21 + lo`` as a Python integer.  No slice sum can
overflow below 2^42 (4.4e12) rows per side; beyond that ANSI mode raises
rather than wrap.  (A ``decimal(38,0)`` sum gives the same number but runs
through ``BigDecimal`` per row, measurably slower.)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, MapType, StringType, StructField, StructType

from ..functions.names import sql_col

_SLICE = (1 << 21) - 1  # low 21 bits
_INTEGRAL_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
_INTEGRAL_ORDER = ["tinyint", "smallint", "int", "bigint"]


def widens(src: DataType, dst: DataType) -> bool:
    """True if every ``src`` value converts to ``dst`` without change (a lossless promotion)."""
    a, b = src.simpleString(), dst.simpleString()
    if a == b:
        return False
    if a in _INTEGRAL_ORDER and b in _INTEGRAL_ORDER:
        return _INTEGRAL_ORDER.index(a) < _INTEGRAL_ORDER.index(b)
    if a == "float" and b == "double":
        return True
    if a in _INTEGRAL_ORDER and b == "string":
        return True  # an integer's text is unique
    if a in ("tinyint", "smallint", "int") and b == "double":
        return True  # at most 31 bits, exact in a double's 53-bit mantissa
    if isinstance(dst, DecimalType):
        if isinstance(src, DecimalType):
            return dst.scale >= src.scale and dst.precision - dst.scale >= src.precision - src.scale
        if a in _INTEGRAL_DIGITS:
            return dst.precision - dst.scale >= _INTEGRAL_DIGITS[a]
    return False


def _hashable(df: DataFrame, name: str, as_type: DataType | None = None, empty_as_null: bool = False) -> Column:
    field = next((f for f in df.schema.fields if f.name == name), None)
    if field is None:  # Spark's own names match whatever their case
        field = next(f for f in df.schema.fields if f.name.lower() == name.lower())
    col = sql_col(name)
    if empty_as_null and isinstance(field.dataType, StringType):
        # a file table stores '' and NULL partition values in one default
        # partition and reads both back as NULL
        col = F.nullif(col, F.lit(""))
    if as_type is not None and widens(field.dataType, as_type):
        # hash the value as the table stores it: a lossless widening on append
        # (int -> bigint, float -> double, …) keeps the value, so both sides agree.
        # Any other type change is hashed as is and shows up as a mismatch.
        col = col.cast(as_type)
        field = StructField(name, as_type)
    if _unhashable(field.dataType):
        # hash() refuses maps and variants, also nested ones; their JSON text
        # keeps entry order, which a Parquet round trip preserves.
        return F.to_json(col)
    return col


def _unhashable(dt: DataType) -> bool:
    if isinstance(dt, MapType) or type(dt).__name__ == "VariantType":
        return True
    if isinstance(dt, ArrayType):
        return _unhashable(dt.elementType)
    if isinstance(dt, StructType):
        return any(_unhashable(f.dataType) for f in dt.fields)
    return False


def fingerprint_exprs(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    as_types: Mapping[str, DataType] | None = None,
    empty_as_null: Sequence[str] = (),
) -> list[Column]:
    """Aggregate expressions over ``columns`` (default: all, by name): ``rows``
    and the three hash slice sums, which :func:`combine` turns into ``hash_sum``.

    ``as_types`` hashes the named columns as those types (the target's), so a
    value widened on the way into the table hashes the same on both sides.
    ``empty_as_null`` names string partition columns of a file table, where
    ``''`` is stored as NULL.
    """
    cols = list(columns) if columns is not None else list(df.columns)
    types = {n.lower(): t for n, t in (as_types or {}).items()}
    blank = {n.lower() for n in empty_as_null}
    row_hash = (
        F.xxhash64(*[_hashable(df, c, types.get(c.lower()), c.lower() in blank) for c in sorted(cols)]) if cols else F.lit(0).cast("bigint")
    )
    return [F.count(F.lit(1)).alias("rows"), *_slice_sums(row_hash)]


def _slice_sums(row_hash: Column) -> list[Column]:
    return [
        F.coalesce(F.sum(F.shiftright(row_hash, 42)), F.lit(0).cast("bigint")).alias("_h_hi"),
        F.coalesce(F.sum(F.shiftright(row_hash, 21).bitwiseAND(_SLICE)), F.lit(0).cast("bigint")).alias("_h_mid"),
        F.coalesce(F.sum(row_hash.bitwiseAND(_SLICE)), F.lit(0).cast("bigint")).alias("_h_lo"),
    ]


def combine(metrics: Mapping[str, object]) -> dict[str, object]:
    """``{"rows", "hash_sum"}`` from the aggregated slice sums (exact Python integers)."""
    hi, mid, lo = (int(metrics.get(k) or 0) for k in ("_h_hi", "_h_mid", "_h_lo"))  # type: ignore[call-overload]
    return {"rows": int(metrics.get("rows") or 0), "hash_sum": (hi << 42) + (mid << 21) + lo}  # type: ignore[call-overload]


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, object]:
    """Run one aggregation job and return ``{"rows": n, "hash_sum": h}``."""
    row = df.agg(*fingerprint_exprs(df, columns)).first()
    return combine(row.asDict()) if row is not None else {"rows": 0, "hash_sum": 0}


def fingerprint_pair(
    left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None
) -> tuple[dict[str, object], dict[str, object]]:
    """Fingerprints of two DataFrames in ONE job: both scans run side by side.

    Each side is reduced to its row hash and a side tag, the two are glued
    with ``unionByName`` and grouped by the tag: partial sums per task, two
    groups in the final merge.  Columns are matched by name.
    """
    cols = sorted(columns if columns is not None else left.columns)

    def hashed(df: DataFrame, side: int) -> DataFrame:
        row_hash = F.xxhash64(*[_hashable(df, c) for c in cols]) if cols else F.lit(0).cast("bigint")
        return df.select(row_hash.alias("_h"), F.lit(side).alias("_side"))

    rows = (
        hashed(left, 0)
        .unionByName(hashed(right, 1))
        .groupBy("_side")
        .agg(F.count(F.lit(1)).alias("rows"), *_slice_sums(F.col("_h")))
        .collect()
    )
    found = {r["_side"]: combine(r.asDict()) for r in rows}
    empty = {"rows": 0, "hash_sum": 0}
    return found.get(0, dict(empty)), found.get(1, dict(empty))


def count_pair(left: DataFrame, right: DataFrame) -> tuple[int, int]:
    """Row counts of two DataFrames in one job; neither side reads a column."""
    tagged = left.select(F.lit(0).alias("_side")).unionByName(right.select(F.lit(1).alias("_side")))
    found = {r["_side"]: int(r["n"]) for r in tagged.groupBy("_side").agg(F.count(F.lit(1)).alias("n")).collect()}
    return found.get(0, 0), found.get(1, 0)


def count_rows(df: DataFrame) -> int:
    """A1/A2: row count; on a file table this reads no column (``ReadSchema: struct<>``)."""
    return int(df.count())


def subtract_fingerprint(after: dict[str, object], before: dict[str, object] | None) -> dict[str, object]:
    if not before:
        return dict(after)
    return {k: after[k] - before.get(k, 0) for k in after}  # type: ignore[operator]


def compare(
    source_rows: int | None,
    target_rows: int | None,
    written_fp: dict[str, object] | None = None,
    target_fp: dict[str, object] | None = None,
) -> tuple[str, str | None]:
    """V6: ``("success", None)`` or ``("mismatch", why)``."""
    if source_rows is None or target_rows is None:
        return "mismatch", "row count missing"
    if source_rows != target_rows:
        return "mismatch", f"source rows {source_rows} != target rows {target_rows}"
    if written_fp is not None and target_fp is not None:
        if written_fp.get("hash_sum") != target_fp.get("hash_sum"):
            return "mismatch", "content fingerprint differs"
    return "success", None
