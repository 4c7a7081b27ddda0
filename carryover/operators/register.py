"""K4 (K4a–K4c, P1), S5: register Hive-style partitioned Parquet as a table, no rewrite.

Steps, all metadata work except the two counts:

1. Infer the layout (S5): schema with partition columns from directory
   names (footer reads; file listing is distributed by Spark for big
   trees), and which columns are partition columns: the ``key=value``
   segments of one file's path (a one-row job), or else the columns the
   files themselves do not hold.
2. ``CREATE NAMESPACE IF NOT EXISTS`` (K5).
3. ``CREATE TABLE IF NOT EXISTS … PARTITIONED BY (…)`` with the column
   list from ``StructType.toDDL()`` (K4a/K4b; it quotes nested field names,
   which the reference's hand-built list did not).
4. Register the files (K4c):

   * session catalog: the table is ``USING parquet LOCATION '<path>'`` and
     ``MSCK REPAIR TABLE … SYNC PARTITIONS`` adds the directories as
     partitions (and drops vanished ones on a re-run, so it is idempotent).
     Such a table is *live*: files added later to a known partition show
     after ``REFRESH TABLE``, a new partition after another repair.  ``incremental=True``
     adds and drops only what changed (:mod:`.sync`).
   * a V2 catalog (Iceberg): the catalog's ``add_files`` procedure, as in
     the reference; the table then holds a fixed file list.

5. Count the files through a plain read (reusing the listing of step 1) and
   the table through the catalog, both in one job, and compare (the
   reference reported the table count as both).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, StringType, StructField, StructType, _parse_datatype_string

from ..functions.names import quote_ident, quote_ref, split_ref, sql_string
from ..sources.parquet import file_schema, qualified_path, read_parquet
from .sync import Synced, sync_partitions
from .validate import count_pair
from .write import catalog_of, ensure_namespace, namespace_of, same_location, table_exists, table_location


@dataclass(frozen=True)
class Layout:
    """Schema of a partitioned Parquet tree and its partition columns (in directory order)."""

    schema: StructType
    partition_columns: tuple[str, ...]

    @property
    def data_columns(self) -> tuple[str, ...]:
        parts = set(self.partition_columns)
        return tuple(f.name for f in self.schema.fields if f.name not in parts)


def infer_layout(
    spark: SparkSession,
    path: str,
    *,
    partition_types: Mapping[str, str] | None = None,
    merge_schema: bool = False,
) -> Layout:
    """S5 + K4a: schema and partition columns of the files under ``path``.

    ``ds=2024-01-15`` is inferred as ``date`` by Spark, ``ds=2024-01`` as
    ``string``; ``partition_types`` (e.g. ``{"ds": "string"}``) overrides.
    """
    return _infer(spark, path, partition_types, merge_schema)[0]


def _infer(
    spark: SparkSession, path: str, partition_types: Mapping[str, str] | None, merge_schema: bool
) -> tuple[Layout, DataFrame]:
    """The layout, and the DataFrame it was read from (its file listing is reused)."""
    df = read_parquet(spark, path, merge_schema=merge_schema)
    inferred = df.schema
    # Directory keys of one file: Spark requires every leaf directory to carry
    # the same keys, so one path is enough (a one-row job).  This also finds a
    # partition column that is stored inside the files as well.
    partition_columns = _path_partition_columns(df, path, {f.name for f in inferred.fields})
    if not partition_columns:
        in_files = {f.name for f in file_schema(spark, path, merge_schema=merge_schema).fields}
        partition_columns = tuple(f.name for f in inferred.fields if f.name not in in_files)
    if partition_types:
        unknown = set(partition_types) - set(partition_columns)
        if unknown:
            raise ValueError(f"partition_types names non-partition columns: {sorted(unknown)}")
        inferred = StructType(
            [
                StructField(f.name, _parse_datatype_string(partition_types[f.name]), True)
                if f.name in partition_types
                else f
                for f in inferred.fields
            ]
        )
    if partition_types:  # read again with the chosen types (Spark honours a given partition type)
        df = read_parquet(spark, path, merge_schema=merge_schema, schema=inferred)
    return Layout(schema=inferred, partition_columns=partition_columns), df


def _path_partition_columns(df: DataFrame, root: str, columns: set[str]) -> tuple[str, ...]:
    from pyspark.sql import functions as F

    first = df.select(F.col("_metadata.file_path").alias("p")).limit(1).collect()
    if not first:
        return ()
    file_path = unquote(first[0]["p"])
    bare_root = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:/*", "/", root.rstrip("/"))
    bare_file = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:/*", "/", file_path)
    rel = bare_file[len(bare_root):] if bare_file.startswith(bare_root + "/") else bare_file
    keys = [seg.split("=", 1)[0] for seg in rel.strip("/").split("/")[:-1] if "=" in seg]
    return tuple(k for k in keys if k in columns)


def layout_rows(spark: SparkSession, layout: Layout) -> DataFrame:
    """K4a as data: one row per column ``(column_name, data_type, is_partition)``."""
    parts = set(layout.partition_columns)
    schema = StructType(
        [
            StructField("column_name", StringType(), False),
            StructField("data_type", StringType(), False),
            StructField("is_partition", BooleanType(), False),
        ]
    )
    rows = [(f.name, f.dataType.simpleString(), f.name in parts) for f in layout.schema.fields]
    return spark.createDataFrame(rows, schema)


def create_table_sql(table: str, layout: Layout, *, fmt: str, location: str | None) -> str:
    """The ``CREATE TABLE IF NOT EXISTS`` statement for a layout."""
    parts = set(layout.partition_columns)
    # Data columns first, partition columns last in directory order, as Spark stores them.
    ordered = [f for f in layout.schema.fields if f.name not in parts] + [
        layout.schema[c] for c in layout.partition_columns
    ]
    ddl = StructType(ordered).toDDL()
    sql = f"CREATE TABLE IF NOT EXISTS {quote_ref(table)} ({ddl}) USING {fmt}"
    if layout.partition_columns:
        sql += " PARTITIONED BY (" + ", ".join(quote_ident(c) for c in layout.partition_columns) + ")"
    if location:
        sql += f" LOCATION {sql_string(location)}"
    return sql


def add_files_sql(catalog: str, table: str, path: str) -> str:
    """The V2 catalog procedure call that registers existing files."""
    source_table = f"`parquet`.{quote_ident(path)}"
    parts = split_ref(table)
    bare = ".".join(parts[1:]) if parts[0] == catalog and len(parts) > 2 else ".".join(parts)
    return (
        f"CALL {quote_ident(catalog)}.system.add_files("
        f"table => {sql_string(bare)}, source_table => {sql_string(source_table)})"
    )


@dataclass
class Registered:
    table: str
    path: str
    layout: Layout
    source_rows: int
    target_rows: int
    rows_before: int
    adds: bool = False  # a V2 table: registering adds to the rows it had
    files: DataFrame | None = None  # the registered files, read through the layout's listing
    synced: Synced | None = None  # what an incremental registration changed

    @property
    def status(self) -> str:
        if self.source_rows < 0 or self.target_rows < 0:
            return "unverified"  # registered with count=False
        return "success" if self.source_rows == self.compared_rows else "mismatch"

    @property
    def compared_rows(self) -> int:
        """What the files' rows are held against: the table, or what a V2 table gained."""
        return self.target_rows - self.rows_before if self.adds else self.target_rows


def register_files(
    spark: SparkSession,
    path: str,
    table: str,
    *,
    partition_columns: Sequence[str] | None = None,
    partition_types: Mapping[str, str] | None = None,
    merge_schema: bool = False,
    fmt: str | None = None,
    count: bool = True,
    incremental: bool = False,
) -> Registered:
    """K4: make the Parquet files under ``path`` queryable as ``table`` without copying them.

    ``partition_columns`` given: it must equal the directory layout (a table
    partitioned by anything else would misread the files).  Not given: the
    discovered layout is used.  An existing table must have the same
    columns, otherwise the call fails instead of silently keeping it.

    ``incremental``: a session table's partitions are compared with the tree and
    only the difference is told to the catalog, instead of a repair of the whole table.

    The same tree again: a session table keeps its rows (the repair is
    idempotent), a V2 catalog's procedure rejects files it already holds.
    """
    path = qualified_path(spark, path)
    layout, files = _infer(spark, path, partition_types, merge_schema)
    if partition_columns is not None and tuple(partition_columns) != layout.partition_columns:
        raise ValueError(
            f"partition columns {list(partition_columns)} do not match the directory layout "
            f"{list(layout.partition_columns)} under {path}"
        )
    catalog = catalog_of(spark, table)
    v1 = catalog == "spark_catalog" and (fmt or "parquet") == "parquet"
    ns = namespace_of(table)
    if ns:
        ensure_namespace(spark, ns)

    rows_before = 0
    if table_exists(spark, table):
        existing = {(f.name, f.dataType.simpleString()) for f in spark.table(quote_ref(table)).schema.fields}
        wanted = {(f.name, f.dataType.simpleString()) for f in layout.schema.fields}
        if existing != wanted:
            raise ValueError(f"{table} exists with different columns; drop it or register elsewhere")
        if v1:
            loc = table_location(spark, table)
            if loc is None or not same_location(loc, path):
                raise ValueError(f"{table} exists over {loc}, not {path}; drop it or register elsewhere")
        if count:
            rows_before = int(spark.table(quote_ref(table)).count())

    synced = None
    if v1:
        spark.sql(create_table_sql(table, layout, fmt="parquet", location=path))
        if incremental:
            synced = sync_partitions(spark, table, path)
        elif layout.partition_columns:
            spark.sql(f"MSCK REPAIR TABLE {quote_ref(table)} SYNC PARTITIONS")
        else:
            spark.sql(f"REFRESH TABLE {quote_ref(table)}")
    else:
        spark.sql(create_table_sql(table, layout, fmt=fmt or "iceberg", location=None))
        spark.sql(add_files_sql(catalog, table, path))

    source_rows = target_rows = -1
    if count:
        # files (through the listing made for the layout) and table, in one job
        source_rows, target_rows = count_pair(files, spark.table(quote_ref(table)))
    return Registered(
        table=table,
        path=path,
        layout=layout,
        source_rows=source_rows,
        target_rows=target_rows,
        rows_before=rows_before,
        adds=not v1,
        files=files,
        synced=synced,
    )
