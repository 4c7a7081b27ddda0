"""Read a tree whose files disagree on columns and types.

``mergeSchema`` adds missing columns but fails when one column is ``int``
in some files and ``bigint`` or ``string`` in others.  Here:

1. Footers are read in tasks (one row per file: its folder and a digest of
   its column layout), and grouped by layout.  Only one representative
   per layout reaches the driver, where Spark itself infers its schema.
2. Per column, the least type that holds the values of all layouts without
   loss (:func:`common_type`).  Partition columns are typed once, over the
   names of all folders.
3. Each layout's files are read with their own schema and cast to the common
   one; the results are joined by ``UNION ALL``.  A column that a layout
   lacks is NULL there.  Filters and column pruning reach every scan, and
   where a layout has the common type already there is no cast at all.

The driver holds what any read of the tree makes it hold, the paths; a layout
that owns whole folders is passed as folders.  The plan grows with the number
of layouts, not of files.

Names match whatever their case, as in Spark; the spelling of the layout
with the smallest path wins, and columns stand in the order in which layouts
(by smallest path) bring them.  Empty files take no part.  No files: an error, as for any
Parquet read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import sql_col

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
#: Stores that tasks can open by themselves, with ranged reads of the footers.
OWN_STORES = ("file", "s3", "s3a", "gs")


class SchemaConflict(ValueError):
    """Two layouts hold one column in types without a common one."""


def _exact_digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point that an exact number type can hold."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return (_DIGITS[type(kind)], 0) if isinstance(kind, _INTEGRAL) else None


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds every value of both without loss, else ``string``.

    Whole numbers and decimals widen (to a decimal where needed); ``float``
    and numbers of up to 15 digits become ``double``; ``bigint`` with
    ``double`` becomes ``string``, as 2**53 + 1 is no double.  ``date`` becomes a
    timestamp at midnight; of the two timestamp types, the one with a time zone wins
    (session zone).  Structs are joined field by field, arrays and maps by
    their elements.  ``binary``, or a nested type, with anything else is a
    :class:`SchemaConflict`.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_struct([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType), True)
    nested = (T.StructType, T.ArrayType, T.MapType, T.BinaryType, T.VariantType)
    if isinstance(a, nested) or isinstance(b, nested):
        raise SchemaConflict(f"no common type of {a.simpleString()} and {b.simpleString()}")
    if isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL):
        return a if _DIGITS[type(a)] > _DIGITS[type(b)] else b
    left, right = _exact_digits(a), _exact_digits(b)
    if left and right:
        whole, scale = max(left[0], right[0]), max(left[1], right[1])
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    floats = (T.FloatType, T.DoubleType)
    if isinstance(a, floats) or isinstance(b, floats):
        digits = right if isinstance(a, floats) else left
        both = isinstance(a, floats) and isinstance(b, floats)
        return T.DoubleType() if both or (digits and digits[1] == 0 and digits[0] <= 15) else T.StringType()
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampType() if T.TimestampType() in (a, b) else T.TimestampNTZType()
    return T.StringType()


def common_struct(schemas: Sequence[T.StructType]) -> T.StructType:
    """Columns of all schemas by name (whatever its case), each in its common type."""
    out: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            seen = out.get(f.name.lower())
            try:
                kind = common_type(seen.dataType, f.dataType) if seen else f.dataType
            except SchemaConflict as exc:
                raise SchemaConflict(f"{f.name}: {exc}") from None
            out[f.name.lower()] = T.StructField(seen.name if seen else f.name, kind, True)
    return T.StructType(list(out.values()))


def conform(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` of type ``have`` as ``want``, a :func:`common_type` of it (fields by name)."""
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        mine = {f.name.lower(): f for f in have.fields}
        fields = []
        for f in want.fields:
            own = mine.get(f.name.lower())
            part = conform(value.getField(own.name), own.dataType, f.dataType) if own else F.lit(None).cast(f.dataType)
            fields.append(part.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: conform(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        keyed = F.transform_keys(value, lambda k, _: conform(k, have.keyType, want.keyType))
        return F.transform_values(keyed, lambda _, v: conform(v, have.valueType, want.valueType))
    return value.cast(want)


def file_layouts(spark: SparkSession, path: str) -> DataFrame:
    """One row per non-empty file below ``path``: ``file``, ``folder``, ``layout`` (a digest of its columns).

    Tasks read footers by ranged reads from local and S3 / GCS paths; files of other
    stores are handed to them whole by Spark, a second read of the data, as only Spark can
    open those.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0")
    scheme = re.match(r"^([A-Za-z][A-Za-z0-9+.-]*):", _any_file(listed) or "file:")
    direct = scheme.group(1).lower() in OWN_STORES  # type: ignore[union-attr]
    rows = listed.select("path", (F.lit(None).cast("binary") if direct else F.col("content")).alias("content"))

    def digest(batches: Iterator) -> Iterator:  # nested, so that it travels by value
        import hashlib
        import io
        import json
        import re

        import pandas as pd
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        def described(handle) -> str:
            meta = pq.ParquetFile(handle).metadata
            leaves = [meta.schema.column(i) for i in range(meta.num_columns)]
            kept = (meta.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
            text = json.dumps(
                [
                    [c.path, c.physical_type, str(c.logical_type), str(c.converted_type), c.length]
                    + [c.max_definition_level, c.max_repetition_level]
                    for c in leaves
                ]
            )
            return hashlib.sha256(text.encode() + b"\0" + kept).hexdigest()

        def footer(uri: str, content) -> str:
            if content is not None:
                return described(io.BytesIO(content))
            if uri.startswith("file:"):
                store, where = pafs.LocalFileSystem(), re.sub("^file:/+", "/", uri)
            else:
                store, where = pafs.FileSystem.from_uri(re.sub("^s3a:", "s3:", uri))
            with store.open_input_file(where) as handle:
                return described(handle)

        for batch in batches:
            layouts = [footer(u, c) for u, c in zip(batch["path"], batch["content"])]
            yield pd.DataFrame({"file": batch["path"], "layout": layouts})

    return rows.mapInPandas(digest, "file string, layout string").withColumn(
        "folder", F.regexp_replace("file", "/[^/]*$", "")
    )


def _any_file(listed: DataFrame) -> str | None:
    first = listed.select("path").limit(1).collect()
    return first[0]["path"] if first else None


def partition_fields(spark: SparkSession, path: str) -> list[T.StructField]:
    """Partition columns of a tree, typed over the names of all its folders; no file is opened."""
    unused = "__no_column_of_any_file"
    schema = spark.read.schema(f"`{unused}` int").parquet(path).schema
    return [f for f in schema.fields if f.name != unused]


@dataclass
class LayoutGroup:
    """Files of one column layout: what to read, and Spark's schema of them."""

    first_file: str
    n_files: int
    paths: list[str]
    schema: T.StructType


def layout_groups(spark: SparkSession, path: str) -> list[LayoutGroup]:
    """The layouts of a tree, by smallest path; layouts that Spark reads alike are one."""
    files = file_layouts(spark, path).persist()
    try:
        in_folder = files.groupBy("folder").agg(F.count_distinct("layout").alias("n_layouts"))
        folders = [r["folder"] for r in in_folder.select("folder").collect()]
        above = {up for f in folders for up in _parents(f)}
        # a folder of one layout, and no folder of files below it, is read by its name
        whole = in_folder.where("n_layouts = 1").select("folder", F.lit(True).alias("whole"))
        read = files.join(whole, "folder", "left").withColumn(
            "unit", F.when(F.col("whole"), F.col("folder")).otherwise(F.col("file"))
        )
        firsts = read.groupBy("layout").agg(F.min("file").alias("first_file"), F.count(F.lit(1)).alias("n")).collect()
        units: dict[str, list[str]] = {}
        for row in read.select("layout", "unit", "folder").distinct().toLocalIterator():
            if row["unit"] != row["folder"] or row["folder"] not in above:
                units.setdefault(row["layout"], []).append(row["unit"])
        split = [f for f in folders if f in above]
        if split:
            nested = spark.createDataFrame([(f,) for f in split], "folder string")
            for row in read.where("whole").join(nested, "folder", "left_semi").select("layout", "file").toLocalIterator():
                units.setdefault(row["layout"], []).append(row["file"])
    finally:
        files.unpersist()
    groups: dict[str, LayoutGroup] = {}
    for row in sorted(firsts, key=lambda r: r["first_file"]):
        schema = spark.read.option("recursiveFileLookup", "true").parquet(_escape(row["first_file"])).schema
        paths = sorted(units[row["layout"]])
        same = groups.get(schema.json())
        if same:
            same.paths, same.n_files = sorted(same.paths + paths), same.n_files + row["n"]
        else:
            groups[schema.json()] = LayoutGroup(row["first_file"], int(row["n"]), paths, schema)
    return list(groups.values())


def _parents(folder: str) -> Iterator[str]:
    while "/" in folder.rstrip("/"):
        folder = folder.rstrip("/").rsplit("/", 1)[0]
        yield folder


def _escape(path: str) -> str:
    """A listed path for a reader that takes globs."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def read_reconciled(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the Parquet tree at ``path`` (a folder), every column in the common type of its layouts."""
    groups = layout_groups(spark, path)
    if not groups:
        raise ValueError(f"no Parquet files under {path}")
    parts = partition_fields(spark, path)
    taken = {p.name.lower() for p in parts}
    own = [T.StructType([f for f in g.schema.fields if f.name.lower() not in taken]) for g in groups]
    wanted = T.StructType(common_struct(own).fields + parts)
    out = None
    for group, schema in zip(groups, own):
        full = T.StructType(schema.fields + parts)
        df = spark.read.schema(full).option("basePath", path).parquet(*[_escape(p) for p in group.paths])
        have = {f.name.lower(): f for f in full.fields}
        columns = []
        for f in wanted.fields:
            mine = have.get(f.name.lower())
            value = conform(sql_col(mine.name), mine.dataType, f.dataType) if mine else F.lit(None).cast(f.dataType)
            columns.append(value.alias(f.name))
        df = df.select(*columns)
        out = df if out is None else out.unionAll(df)
    return out  # type: ignore[return-value]
