"""One function per inventory key: ``(spark, sf_dir) -> DataFrame``.

Each key runs the real operator on the given tables — writes go to a
fresh database or folder under the shared scratch location — and returns
a lazy DataFrame over what landed, in the source's column order (a
partitioned write moves partition columns to the end).  ``ORACLES``
holds the equivalent DuckDB SQL over the original tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import (
    append_once,
    difference,
    export_partitioned,
    fingerprint_pair,
    infer_layout,
    layout_rows,
    limit_rows,
    load_overwrite,
    partition_stats,
    read_statistics,
    record_statistics,
    register_files,
    replicate_partitions,
    rows_not_in,
    sync_partitions,
    tag_partition,
    write_table,
)
from .operators.versions import delete_folder
from .plans.batch import MigrationOptions, run_migration, select_tables, summarize
from .plans.staging import stage_exports, stage_tables
from .plans.checks import (
    count_equal_sql,
    distinct_partitions_sql,
    info_sql,
    non_empty_sql,
    parse_checks,
    partition_has_rows_sql,
    run_checks,
)
from .session import scratch_database, scratch_path
from .sources import CatalogSource, ParquetSource, get_source, read_parquet, register_arrow_files, scan_path_sql

# Fixed values of the reference's staging and check files.
PRUNE_DS = "2024-01-15"
REPLICA_DS = ("2024-01-15", "2024-01-16")
SAMPLE_ROWS = 10_000


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _events_with_ds(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ds written as text, as the reference's export writes a string literal.
    return _read(spark, sf_dir, "events").withColumn("ds", F.date_format("ts", "yyyy-MM-dd"))


def _export_events(spark: SparkSession, sf_dir: str):
    path = scratch_path(spark, "events_raw")
    return export_partitioned(_events_with_ds(spark, sf_dir), path, ["ds"])


def _registered_events(spark: SparkSession, sf_dir: str) -> str:
    exported = _export_events(spark, sf_dir)
    db, _ = scratch_database(spark, "reg")
    table = f"{db}.events"
    reg = register_files(spark, exported.path, table, partition_columns=["ds"])
    if reg.status != "success":
        raise RuntimeError(f"registration mismatch: {reg}")
    return table


def _copy(spark: SparkSession, df: DataFrame, name: str, **kwargs) -> tuple[str, DataFrame]:
    db, _ = scratch_database(spark, "copy")
    table = f"{db}.{name}"
    write_table(df, table, "create", **kwargs)
    return table, spark.table(table).select(*df.columns)


# --- scans / sources -------------------------------------------------------


def scan_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table saved in the catalog, read back by ``db.table`` through a catalog source."""
    db, _ = scratch_database(spark, "scan")
    load_overwrite(_read(spark, sf_dir, "orders"), f"{db}.orders")
    return CatalogSource(database=db).read(spark, "orders")


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Parquet path through the Parquet source."""
    return ParquetSource().read(spark, _path(sf_dir, "customer"))


def scan_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ``ds=``-partitioned tree read back with partition discovery (``ds`` inferred as date)."""
    exported = _export_events(spark, sf_dir)
    return ParquetSource().read(spark, exported.path)


def infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inferred columns and which of them come from directory names."""
    exported = _export_events(spark, sf_dir)
    return layout_rows(spark, infer_layout(spark, exported.path))


def scan_path_sql_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A path queried as ``parquet.`path``` in SQL."""
    return scan_path_sql(spark, _path(sf_dir, "supplier"))


def scan_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3/S5 option: files with different columns under one root, read with ``mergeSchema``.

    ``orders`` is written in two parts: status ``F`` with every column, the
    rest without ``o_orderpriority``; the merged read has the column, NULL
    where a file lacks it.
    """
    orders = _read(spark, sf_dir, "orders")
    root = scratch_path(spark, "merge")
    orders.where(F.col("o_orderstatus").eqNullSafe("F")).write.parquet(f"{root}/part=full")
    orders.where(~F.col("o_orderstatus").eqNullSafe("F")).drop("o_orderpriority").write.parquet(f"{root}/part=narrow")
    return read_parquet(spark, root, merge_schema=True).select(*orders.columns)


def scan_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` in files of three layouts, copied as one table of common types.

    Customers are ``int``, ``bigint`` and text, totals ``double`` and
    ``float``, and status ``P`` lacks the priority (``mergeSchema`` fails on such a tree).
    """
    orders = _read(spark, sf_dir, "orders")
    root = scratch_path(spark, "layouts")
    status = F.coalesce(F.col("o_orderstatus"), F.lit(""))
    rest = orders.where(~status.isin("F", "P"))
    filled = orders.where(status == "F").withColumn("o_custkey", F.col("o_custkey").cast("int"))
    filled.write.parquet(f"{root}/part=1")
    rest.withColumn("o_custkey", F.col("o_custkey").cast("string")).write.parquet(f"{root}/part=2")
    partial = orders.where(status == "P").withColumn("o_totalprice", F.col("o_totalprice").cast("float"))
    partial.drop("o_orderpriority").write.parquet(f"{root}/part=3")
    db, _ = scratch_database(spark, "rec")
    run_migration(spark, ParquetSource(reconcile=True), [root], MigrationOptions(database=db), targets={root: "orders"})
    return spark.table(f"{db}.orders").select(*orders.columns)


def scan_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` written as Arrow IPC files and migrated from them, files read in several splits."""
    items = _read(spark, sf_dir, "lineitem")
    root = scratch_path(spark, "arrow")
    register_arrow_files(spark)
    items.write.format("arrow_files").mode("append").save(root)
    source = get_source("arrow", split_bytes=256 * 1024)
    if source.read(spark, root).rdd.getNumPartitions() < 2:
        raise RuntimeError("one split")
    db, _ = scratch_database(spark, "arrow")
    run_migration(spark, source, [root], MigrationOptions(database=db), targets={root: "lineitem"})
    return spark.table(f"{db}.lineitem")


# --- transforms ------------------------------------------------------------


def limit_rows_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3+K6: staging load capped at the reference's default sample size, then counted."""
    db, _ = scratch_database(spark, "limit")
    load_overwrite(_read(spark, sf_dir, "lineitem"), f"{db}.lineitem", max_rows=SAMPLE_ROWS)
    return spark.table(f"{db}.lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


def limit_rows_parallel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 in parallel: ``lineitem`` in eight files, capped by quotas of its files; rows kept and rows not of the table."""
    path = scratch_path(spark, "capped")
    _read(spark, sf_dir, "lineitem").repartition(8).write.parquet(path)
    files = spark.read.parquet(path)
    capped = limit_rows(files, SAMPLE_ROWS, parallel=True)
    foreign = rows_not_in(capped, files).agg(F.count("*").alias("n_foreign"))
    return capped.agg(F.count("*").alias("n_rows")).crossJoin(foreign)


def tag_partition_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4+K7: constant ``ds`` column, exported by ``ds`` and read back."""
    orders = _read(spark, sf_dir, "orders")
    path = scratch_path(spark, "tagged")
    export_partitioned(tag_partition(orders, "ds", PRUNE_DS), path, ["ds"])
    return spark.read.parquet(path).select(*orders.columns, "ds")


def replicate_partitions_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5+K7: the whole input once per ``ds`` value, in one scan and one write."""
    orders = _read(spark, sf_dir, "orders")
    path = scratch_path(spark, "replicated")
    export_partitioned(replicate_partitions(orders, "ds", REPLICA_DS), path, ["ds"])
    return spark.read.parquet(path).select(*orders.columns, "ds")


def repartition_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1+K1: round-robin into 3 tasks, create, read back."""
    return _copy(spark, _read(spark, sf_dir, "orders"), "orders", repartition=3)[1]


def compact_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 ``repartition="auto"``: ``orders`` spread over many small files, copied as AQE-sized files."""
    orders = _read(spark, sf_dir, "orders")
    small = scratch_path(spark, "small_files")
    orders.repartition(24).write.parquet(small)
    was = spark.conf.get("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")  # "auto" sizing is AQE's; restored below
    try:
        return _copy(spark, spark.read.parquet(small).select(*orders.columns), "orders", repartition="auto")[1]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)


# --- write modes -----------------------------------------------------------


def write_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1+K5: create a new table."""
    return _copy(spark, _read(spark, sf_dir, "part"), "part")[1]


def write_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create partitioned by identity columns (rebalanced on them first)."""
    return _copy(spark, _read(spark, sf_dir, "lineitem"), "lineitem", partition_by=["l_returnflag"])[1]


def write_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: a table of ``nation`` replaced, schema and rows, by ``customer``."""
    db, _ = scratch_database(spark, "replace")
    table = f"{db}.t"
    write_table(_read(spark, sf_dir, "nation"), table, "create")
    customer = _read(spark, sf_dir, "customer")
    write_table(customer, table, "replace")
    return spark.table(table).select(*customer.columns)


def write_replace_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 staged: ``nation`` replaced by ``customer`` through a staging table and renames."""
    db, _ = scratch_database(spark, "staged")
    table = f"{db}.t"
    write_table(_read(spark, sf_dir, "nation"), table, "create")
    customer = _read(spark, sf_dir, "customer")
    write_table(customer, table, "replace", staged=True)
    return spark.table(table).select(*customer.columns)


def write_replace_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2/K6: ``lineitem`` by return flag, replaced twice by pointing the table at new versions of its files."""
    df = _read(spark, sf_dir, "lineitem")
    db, _ = scratch_database(spark, "pointer")
    write_table(df.where("l_returnflag <> 'N'"), f"{db}.lineitem", "create", partition_by=["l_returnflag"])
    write_table(df.where("l_returnflag <> 'A'"), f"{db}.lineitem", "replace", partition_by=["l_returnflag"], staged="pointer")
    write_table(df, f"{db}.lineitem", "replace", partition_by=["l_returnflag"], staged="pointer")
    return spark.table(f"{db}.lineitem").select(*df.columns)


def append_once_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3/O2: ``orders`` loaded in two loads by status, each tried twice; every row once."""
    df = _read(spark, sf_dir, "orders")
    db, _ = scratch_database(spark, "once")
    write_table(df.limit(0), f"{db}.orders", "create", partition_by=["o_orderstatus"])
    first = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    for load, rows in (("filled", df.where(first)), ("rest", df.where(~first)), ("filled", df.where(first)), ("rest", df.where(~first))):
        append_once(rows, f"{db}.orders", load)
    return spark.table(f"{db}.orders").select(*df.columns)


def write_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: create ``nation``, append ``nation`` again."""
    db, _ = scratch_database(spark, "append")
    table = f"{db}.nation"
    nation = _read(spark, sf_dir, "nation")
    write_table(nation, table, "create")
    write_table(nation, table, "append")
    return spark.table(table).select(*nation.columns)


def load_overwrite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: overwrite-load twice; the table holds one copy."""
    db, _ = scratch_database(spark, "load")
    part = _read(spark, sf_dir, "part")
    load_overwrite(part, f"{db}.part")
    load_overwrite(part, f"{db}.part")
    return spark.table(f"{db}.part").select(*part.columns)


def export_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 ``overwrite``: orders exported for two days, then one day exported again with overwrite;
    only that day is replaced, so the tree holds each day once."""
    orders = _read(spark, sf_dir, "orders")
    path = scratch_path(spark, "overwrite")
    export_partitioned(replicate_partitions(orders, "ds", REPLICA_DS), path, ["ds"])
    export_partitioned(tag_partition(orders, "ds", REPLICA_DS[1]), path, ["ds"], mode="overwrite")
    return spark.read.parquet(path).select(*orders.columns, "ds")


def export_partitioned_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7+A3: export ``events`` by day; rows written per ``ds``."""
    exported = _export_events(spark, sf_dir)
    return exported.partitions.select(F.col("ds").cast("string").alias("ds"), "n_rows")


# --- registration ------------------------------------------------------------


def register_files_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export, register without rewriting, read the table."""
    return spark.table(_registered_events(spark, sf_dir))


def register_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4a option: register with the partition type chosen (``ds`` kept as text, not inferred as date)."""
    exported = _export_events(spark, sf_dir)
    db, _ = scratch_database(spark, "regtyped")
    register_files(spark, exported.path, f"{db}.events", partition_types={"ds": "string"})
    return spark.table(f"{db}.events")


def register_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` registered without 2024-01-15 and with a day too many, then synced by difference."""
    events = _events_with_ds(spark, sf_dir)
    path, table = scratch_path(spark, "events_live"), f"{scratch_database(spark, 'live')[0]}.events"
    day = F.col("ds").eqNullSafe(PRUNE_DS)
    export_partitioned(events.where(~day).withColumn("ds", F.coalesce("ds", F.lit("2000-01-01"))), path, ["ds"])
    export_partitioned(events.where(day).withColumn("ds", F.lit("2099-01-01")), path, ["ds"])
    register_files(spark, path, table, incremental=True, count=False)
    export_partitioned(events.where(day), path, ["ds"])
    delete_folder(spark, f"{path}/ds=2099-01-01")
    found = sync_partitions(spark, table)
    if found.statements > 2:
        raise RuntimeError(f"more than the difference was told to the catalog: {found}")
    return spark.table(table)


def partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count one ``ds`` of the registered table (one directory read)."""
    table = _registered_events(spark, sf_dir)
    return spark.table(table).where(F.col("ds") == F.lit(PRUNE_DS).cast("date")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def file_stats_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-file statistics of a partitioned copy of ``orders``, rolled up per partition."""
    table, _ = _copy(spark, _read(spark, sf_dir, "orders"), "orders", partition_by=["o_orderstatus"])
    stats = partition_stats(spark.table(table), ["o_orderkey", "o_custkey"], ["o_orderstatus"])
    return stats.select(
        "o_orderstatus",
        "n_rows",
        F.col("min_o_orderkey").alias("min_key"),
        F.col("max_o_orderkey").alias("max_key"),
        F.col("nulls_o_custkey").alias("null_custkey"),
    )


# --- checks ------------------------------------------------------------------


def merged_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` by return flag in three loads, one of them replaced; statistics merged from the loads' own.

    Distinct counts and medians are held against the rows: within 5 % (three standard errors), and within
    3 % of the middle rank.
    """
    items = _read(spark, sf_dir, "lineitem")
    table = f"{scratch_database(spark, 'stats')[0]}.lineitem_stats"
    parts, columns = ["l_returnflag"], ["l_orderkey", "l_shipdate", "l_extendedprice", "l_tax"]
    first = F.coalesce(F.col("l_orderkey") % 2 == 0, F.lit(False))
    returned = F.col("l_returnflag").eqNullSafe("R")
    for rows, resets in (
        (items.where(first), False),
        (items.where(~first & ~returned), False),
        (items.where(returned), True),  # a third of the rows, put in place of what the first load said of them
    ):
        record_statistics(rows, table, columns, parts, quantiles=["l_extendedprice"], resets=resets)
    found = read_statistics(spark, table, parts).select(
        F.col("l_returnflag").alias("flag"), "n_rows", "min_l_orderkey", "max_l_orderkey", "nulls_l_orderkey",
        "min_l_shipdate", "max_l_shipdate", "min_l_extendedprice", "max_l_extendedprice", "max_l_tax",
        F.col("distinct_l_orderkey").alias("estimate"), F.col("quantiles_l_extendedprice")[0].alias("median"),
    )
    price = F.col("l_extendedprice")
    exact = items.join(found.select("flag", "median"), F.col("l_returnflag").eqNullSafe(F.col("flag")))
    exact = exact.groupBy("flag").agg(
        F.count_distinct("l_orderkey").alias("n_distinct"),
        (F.count_if(price < F.col("median")) / F.count("l_extendedprice")).alias("below"),
        (F.count_if(price <= F.col("median")) / F.count("l_extendedprice")).alias("upto"),
    ).withColumnRenamed("flag", "same")
    both = found.join(exact, F.col("flag").eqNullSafe(F.col("same")))
    return both.select(
        F.col("flag").alias("l_returnflag"), *found.columns[1:10],
        (F.abs(F.col("estimate") - F.col("n_distinct")) <= 0.05 * F.col("n_distinct")).alias("distinct_ok"),
        ((F.col("below") <= 0.53) & (F.col("upto") >= 0.47)).alias("median_ok"),
    )


def _orders_copy(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    db, _ = scratch_database(spark, "chk")
    source = f"{db}.orders_src"
    load_overwrite(_read(spark, sf_dir, "orders"), source)
    target = f"{db}.orders"
    write_table(spark.table(source), target, "create")
    return source, target


def check_count_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source and copy have equal row counts."""
    source, target = _orders_copy(spark, sf_dir)
    return spark.sql(count_equal_sql(source, target))


def check_non_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: the copy has rows."""
    _, target = _orders_copy(spark, sf_dir)
    return spark.sql(non_empty_sql(target))


def check_distinct_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: the registered table's ``ds`` has values."""
    return spark.sql(distinct_partitions_sql(_registered_events(spark, sf_dir), "ds"))


def check_partition_has_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ds = '2024-01-15'`` has rows."""
    return spark.sql(partition_has_rows_sql(_registered_events(spark, sf_dir), "ds", PRUNE_DS))


def info_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copy summary query over two copied tables."""
    orders, _ = _copy(spark, _read(spark, sf_dir, "orders"), "orders")
    lineitem, _ = _copy(spark, _read(spark, sf_dir, "lineitem"), "lineitem")
    return spark.sql(info_sql([("orders", orders), ("lineitem", lineitem)], count_alias="table_rows"))


def info_partition_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registration summary query (rows and partitions per table)."""
    events = _registered_events(spark, sf_dir)
    lineitem, _ = _copy(spark, _read(spark, sf_dir, "lineitem"), "lineitem", partition_by=["l_returnflag"])
    return spark.sql(info_sql([("events", events, "ds"), ("lineitem", lineitem, "l_returnflag")]))


CHECK_TEXT = """\
-- every outcome a check can have, over a registered tree and a copied table

-- ASSERT: rows of the tree
SELECT count(*) > 0 FROM {events}

-- ASSERT: more than one day in the tree
SELECT count(DISTINCT ds) > 1 FROM {events}

-- ASSERT: mid-January is there
SELECT max(ds = DATE '2024-01-15') FROM {events}

-- ASSERT: the copy is as long as its file
SELECT (SELECT count(*) FROM {orders_src}) = (SELECT count(*) FROM {orders});

-- ASSERT: a day nobody recorded (must fail)

SELECT count(*) > 0 FROM {events} WHERE ds = '1999-01-01'

-- ASSERT: a missing table (must err)
SELECT true FROM {missing}

-- ASSERT: only the first row is judged
SELECT ds = DATE '2024-01-01' FROM {events} WHERE ds <= '2024-01-02' ORDER BY ds

-- ASSERT: nothing to judge (must fail)
SELECT true FROM {orders} WHERE false

SELECT ds, count(*) AS n FROM {events} GROUP BY ds

SELECT o_orderkey, 1 DIV (o_orderkey - (SELECT max(o_orderkey) FROM {orders})) AS late FROM {orders}
"""


def run_checks_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1–V5: passing, failing, erroring, empty and information checks, one report row each."""
    events = _registered_events(spark, sf_dir)
    source, target = _orders_copy(spark, sf_dir)
    text = CHECK_TEXT.format(events=events, orders_src=source, orders=target, missing=f"{source}_missing")
    run = run_checks(spark, parse_checks(text))
    return run.report.select("position", "label", "kind", "status")


FUSED_TEXT = """
-- ASSERT: orders not empty
SELECT count(*) > 0 AS ok FROM {orders}

-- ASSERT: orders have statuses
SELECT count(DISTINCT o_orderstatus) BETWEEN 1 AND 5 FROM {orders}

-- ASSERT: filled orders
SELECT count(*) > 0 AS ok FROM {orders} WHERE o_orderstatus = 'F'

-- ASSERT: no negative total
SELECT count(*) FILTER (WHERE o_totalprice < 0) = 0 FROM {orders}

-- ASSERT: dear orders
SELECT count(*) > 100000000 AS ok FROM {orders} WHERE o_totalprice > 1000

-- ASSERT: items outnumber orders
SELECT (SELECT count(*) FROM {lineitem}) > (SELECT count(*) FROM {orders}) AS ok

-- ASSERT: quantities add up
SELECT sum(l_quantity) > 0 AND min(l_discount) >= 0 FROM {lineitem}

-- ASSERT: returned items
SELECT count(*) > 0 AS ok FROM {lineitem} WHERE l_returnflag = 'R'
"""


def fused_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight assertions over copies of two tables, answered by one scan of each."""
    names = {n: _copy(spark, _read(spark, sf_dir, n), n)[0] for n in ("orders", "lineitem")}
    run = run_checks(spark, parse_checks(FUSED_TEXT.format(**names)), fuse=True)
    return run.report.select("position", "label", "status")


# --- validation and batch ----------------------------------------------------

BATCH_TABLES = ("lineitem", "orders", "customer")


def _batch_refs(sf_dir: str, names=BATCH_TABLES) -> list[str]:
    return [_path(sf_dir, n) for n in names]


def row_count_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6/A1/A2: copy three tables; rows written vs rows in each target."""
    db, _ = scratch_database(spark, "valid")
    report = run_migration(spark, ParquetSource(), _batch_refs(sf_dir), MigrationOptions(database=db))
    return report.select(
        F.regexp_extract("target", r"`([^`]+)`$", 1).alias("tbl"), "source_rows", "target_rows", "status"
    )


def content_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6 with content: create, then append, each checked by an additive row-hash fingerprint."""
    db, _ = scratch_database(spark, "content")
    refs = _batch_refs(sf_dir, ("lineitem", "orders"))
    first = run_migration(spark, ParquetSource(), refs, MigrationOptions(database=db, verify="content"))
    again = run_migration(
        spark, ParquetSource(), refs, MigrationOptions(database=db, mode="append", verify="content")
    )
    both = first.unionByName(again)
    return both.select(
        F.regexp_extract("target", r"`([^`]+)`$", 1).alias("tbl"),
        "mode",
        "source_rows",
        "target_rows",
        "added_rows",
        "status",
    )


def content_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6 content, two existing sides: each file vs its partitioned copy, in one pass per pair."""
    rows = []
    for name, part in (("lineitem", "l_returnflag"), ("orders", "o_orderstatus")):
        src = _read(spark, sf_dir, name)
        table, _ = _copy(spark, src, name, partition_by=[part])
        a, b = fingerprint_pair(src, spark.table(table))
        rows.append((name, int(a["rows"]), int(b["rows"]), a == b))
    return spark.createDataFrame(rows, "tbl string, source_rows bigint, target_rows bigint, same_content boolean")


def content_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6: rows lost, changed and doubled between ``lineitem`` and a partitioned copy, by descending fingerprints."""
    df = _read(spark, sf_dir, "lineitem")
    k, returned = F.col("l_orderkey") % 97, F.col("l_returnflag") == "R"
    tax = F.when((k == 2) & returned, F.lit(9.5)).otherwise(F.col("l_tax"))
    other = df.where((k != 1) | ~returned).withColumn("l_tax", tax).unionByName(df.where((k == 3) & returned))
    table, _ = _copy(spark, other, "lineitem", partition_by=["l_returnflag"])
    return difference(df, spark.table(table), ["l_returnflag"])


def append_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + V6: events by day without 2024-01-15, then that day appended; ``target_rows`` is the whole table."""
    db, _ = scratch_database(spark, "apday")
    events = _read(spark, sf_dir, "events").withColumn("ds", F.to_date("ts"))
    of_day = F.col("ds").eqNullSafe(F.lit(PRUNE_DS).cast("date"))
    write_table(events.where(~of_day), f"{db}.events", "create", partition_by=["ds"])
    day = scratch_path(spark, "day")
    events.where(of_day).write.parquet(day)
    report = run_migration(
        spark, ParquetSource(), [day], MigrationOptions(database=db, mode="append"), targets={day: "events"}
    )
    return report.select("mode", "source_rows", "added_rows", "target_rows", "status")


def migration_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three refs, one missing; the missing one fails alone."""
    db, _ = scratch_database(spark, "batch")
    refs = [_path(sf_dir, "orders"), _path(sf_dir, "no_such_table"), _path(sf_dir, "customer")]
    report = run_migration(spark, ParquetSource(), refs, MigrationOptions(database=db), parallelism=2)
    return report.select(
        F.regexp_extract("source", r"([^/]+)$", 1).alias("src"),
        F.regexp_extract("target", r"`([^`]+)`$", 1).alias("tbl"),
        "source_rows",
        "target_rows",
        "status",
        F.col("error").isNotNull().alias("has_error"),
    )


class _Slowed(ParquetSource):
    """Reads ``customer`` through a step that takes a minute a task."""

    def read(self, spark: SparkSession, ref: str) -> DataFrame:
        df = super().read(spark, ref)
        if "customer" not in ref:
            return df

        def slowly(batches):  # nested, so that it travels by value
            import time

            time.sleep(60)
            yield from batches

        return df.mapInPandas(slowly, df.schema)


def migrate_deadline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: four tables at once, largest first, the slow one cancelled at its deadline; the rest land, it leaves no table."""
    db, _ = scratch_database(spark, "late")
    refs = _batch_refs(sf_dir, ("customer", "orders", "nation", "lineitem"))
    limits = {refs[0]: 2.0}
    report = run_migration(
        spark, _Slowed(), refs, MigrationOptions(database=db), parallelism=4, timeout=limits, longest_first=True
    )
    name = F.element_at(F.split("target", "[.]"), -1)
    tables = spark.sql(f"SHOW TABLES IN {db}").select(F.col("tableName"))
    left = report.join(tables, F.replace(name, F.lit("`"), F.lit("")) == F.col("tableName"), "left")
    return left.select(
        F.replace(name, F.lit("`"), F.lit("")).alias("name"),
        "status",
        "target_rows",
        F.col("tableName").isNotNull().alias("has_table"),
    )


def migrate_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: three tables configured, two asked for (with an empty name in the list)."""
    db, _ = scratch_database(spark, "subset")
    configured = [_path(sf_dir, n) for n in ("orders", "customer", "part")]
    wanted = select_tables(configured, f"{_path(sf_dir, 'orders')},,{_path(sf_dir, 'part')}")
    report = run_migration(spark, ParquetSource(), wanted, MigrationOptions(database=db))
    return report.select(F.regexp_extract("target", r"`([^`]+)`$", 1).alias("tbl"), "target_rows", "status")


def migration_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch report of ``migration_report`` grouped by status."""
    db, _ = scratch_database(spark, "summary")
    refs = [_path(sf_dir, "orders"), _path(sf_dir, "no_such_table"), _path(sf_dir, "customer")]
    return summarize(run_migration(spark, ParquetSource(), refs, MigrationOptions(database=db)))


def register_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 register branch: two exported trees registered in one batch, counts compared."""
    events = _export_events(spark, sf_dir)
    orders = _read(spark, sf_dir, "orders")
    opath = scratch_path(spark, "orders_raw")
    export_partitioned(orders, opath, ["o_orderstatus"])
    db, _ = scratch_database(spark, "regbatch")
    report = run_migration(
        spark,
        ParquetSource(),
        [events.path, opath],
        MigrationOptions(database=db, mode="register"),
        targets={events.path: "events", opath: "orders"},
    )
    return report.select(
        F.regexp_extract("target", r"`([^`]+)`$", 1).alias("tbl"), "source_rows", "target_rows", "status"
    )


def stage_tables_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging load (K6 per table): whole tables overwritten into a database, rows per table."""
    db, _ = scratch_database(spark, "stage")
    report = stage_tables(spark, {n: _path(sf_dir, n) for n in ("orders", "lineitem")}, db, max_rows=0)
    return report.select("name", "n_rows", "status")


def stage_exports_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging export (T5+K7+A3 per table): each whole table once per ds value, rows per (table, ds)."""
    root = scratch_path(spark, "stage_raw")
    out = stage_exports(spark, {n: _path(sf_dir, n) for n in ("orders", "customer")}, root, max_rows=0,
                        ds_values=REPLICA_DS)
    return out.select("name", "ds", "n_rows")


KEYS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_catalog_table": scan_catalog_table,
    "scan_parquet": scan_parquet,
    "scan_partitioned": scan_partitioned,
    "infer_schema": infer_schema,
    "scan_path_sql": scan_path_sql_key,
    "scan_merge_schema": scan_merge_schema,
    "limit_rows": limit_rows_key,
    "tag_partition": tag_partition_key,
    "replicate_partitions": replicate_partitions_key,
    "repartition_write": repartition_write,
    "compact_write": compact_write,
    "write_create": write_create,
    "write_partitioned": write_partitioned,
    "write_replace": write_replace,
    "write_replace_staged": write_replace_staged,
    "write_append": write_append,
    "load_overwrite": load_overwrite_key,
    "export_partitioned": export_partitioned_key,
    "export_overwrite": export_overwrite,
    "register_files": register_files_key,
    "register_typed": register_typed,
    "partition_prune": partition_prune,
    "file_stats": file_stats_key,
    "check_count_equal": check_count_equal,
    "check_non_empty": check_non_empty,
    "check_distinct_partitions": check_distinct_partitions,
    "check_partition_has_rows": check_partition_has_rows,
    "info_sample": info_sample,
    "info_partition_sample": info_partition_sample,
    "run_checks": run_checks_key,
    "row_count_validation": row_count_validation,
    "content_validation": content_validation,
    "content_compare": content_compare,
    "append_partitioned": append_partitioned,
    "migration_report": migration_report,
    "migrate_subset": migrate_subset,
    "migration_summary": migration_summary,
    "register_report": register_report,
    "stage_tables": stage_tables_key,
    "stage_exports": stage_exports_key,
    "fused_checks": fused_checks,
    "write_replace_pointer": write_replace_pointer,
    "append_once": append_once_key,
    "limit_rows_parallel": limit_rows_parallel,
    "content_difference": content_difference,
    "scan_reconciled": scan_reconciled,
    "register_incremental": register_incremental,
    "migrate_deadline": migrate_deadline,
    "merged_statistics": merged_statistics,
    "scan_arrow": scan_arrow,
}

_EVENTS_DS = "SELECT *, CAST(ts AS DATE) AS ds FROM events"
_COUNT_OK = "'success' AS status"

ORACLES: dict[str, str] = {
    "scan_catalog_table": "SELECT * FROM orders",
    "scan_parquet": "SELECT * FROM customer",
    "scan_partitioned": _EVENTS_DS,
    "infer_schema": (
        "SELECT * FROM (VALUES ('event_id', 'bigint', false), ('ts', 'timestamp_ntz', false), "
        "('user_id', 'bigint', false), ('event_type', 'string', false), ('value', 'double', false), "
        "('props', 'string', false), ('ds', 'date', true)) AS t(column_name, data_type, is_partition)"
    ),
    "scan_path_sql": "SELECT * FROM supplier",
    "scan_merge_schema": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
        "CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority FROM orders"
    ),
    "limit_rows": (
        f"SELECT CAST(CASE WHEN count(*) < {SAMPLE_ROWS} THEN count(*) ELSE {SAMPLE_ROWS} END AS BIGINT) "
        "AS n_rows FROM lineitem"
    ),
    "tag_partition": f"SELECT *, DATE '{PRUNE_DS}' AS ds FROM orders",
    "replicate_partitions": (
        f"SELECT *, DATE '{REPLICA_DS[0]}' AS ds FROM orders "
        f"UNION ALL SELECT *, DATE '{REPLICA_DS[1]}' AS ds FROM orders"
    ),
    "repartition_write": "SELECT * FROM orders",
    "write_create": "SELECT * FROM part",
    "compact_write": "SELECT * FROM orders",
    "write_replace_staged": "SELECT * FROM customer",
    "write_partitioned": "SELECT * FROM lineitem",
    "write_replace": "SELECT * FROM customer",
    "write_append": "SELECT * FROM nation UNION ALL SELECT * FROM nation",
    "load_overwrite": "SELECT * FROM part",
    "export_partitioned": (
        "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS ds, count(*) AS n_rows FROM events GROUP BY 1"
    ),
    "register_files": _EVENTS_DS,
    "register_typed": "SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS ds FROM events",
    "export_overwrite": (
        f"SELECT *, DATE '{REPLICA_DS[0]}' AS ds FROM orders "
        f"UNION ALL SELECT *, DATE '{REPLICA_DS[1]}' AS ds FROM orders"
    ),
    "partition_prune": (
        f"SELECT count(*) AS n_rows FROM events WHERE CAST(ts AS DATE) = DATE '{PRUNE_DS}'"
    ),
    "file_stats": (
        "SELECT o_orderstatus, count(*) AS n_rows, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key, "
        "count(*) - count(o_custkey) AS null_custkey FROM orders GROUP BY o_orderstatus"
    ),
    "check_count_equal": "SELECT (SELECT count(*) FROM orders) = (SELECT count(*) FROM orders) AS ok",
    "check_non_empty": "SELECT count(*) > 0 AS ok FROM orders",
    "check_distinct_partitions": "SELECT count(DISTINCT CAST(ts AS DATE)) > 0 AS ok FROM events",
    "check_partition_has_rows": (
        f"SELECT count(*) > 0 AS ok FROM events WHERE CAST(ts AS DATE) = DATE '{PRUNE_DS}'"
    ),
    "info_sample": (
        "SELECT 'orders' AS tbl, count(*) AS table_rows FROM orders "
        "UNION ALL SELECT 'lineitem', count(*) FROM lineitem"
    ),
    "info_partition_sample": (
        "SELECT 'events' AS tbl, count(*) AS n_rows, count(DISTINCT CAST(ts AS DATE)) AS partitions FROM events "
        "UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_returnflag) FROM lineitem"
    ),
    "run_checks": (
        "SELECT * FROM (VALUES "
        "(1, 'rows of the tree', 'assert', 'passed'), "
        "(2, 'more than one day in the tree', 'assert', 'passed'), "
        "(3, 'mid-January is there', 'assert', 'passed'), "
        "(4, 'the copy is as long as its file', 'assert', 'passed'), "
        "(5, 'a day nobody recorded (must fail)', 'assert', 'failed'), "
        "(6, 'a missing table (must err)', 'assert', 'error'), "
        "(7, 'only the first row is judged', 'assert', 'passed'), "
        "(8, 'nothing to judge (must fail)', 'assert', 'failed'), "
        "(9, 'Query #9', 'info', 'passed'), "
        "(10, 'Query #10', 'info', 'error')"
        ") AS t(position, label, kind, status)"
    ),
    "row_count_validation": (
        f"SELECT 'lineitem' AS tbl, count(*) AS source_rows, count(*) AS target_rows, {_COUNT_OK} FROM lineitem "
        "UNION ALL SELECT 'orders', count(*), count(*), 'success' FROM orders "
        "UNION ALL SELECT 'customer', count(*), count(*), 'success' FROM customer"
    ),
    "content_validation": (
        "SELECT 'lineitem' AS tbl, 'create' AS mode, count(*) AS source_rows, count(*) AS target_rows, "
        f"count(*) AS added_rows, {_COUNT_OK} FROM lineitem "
        "UNION ALL SELECT 'orders', 'create', count(*), count(*), count(*), 'success' FROM orders "
        "UNION ALL SELECT 'lineitem', 'append', count(*), 2 * count(*), count(*), 'success' FROM lineitem "
        "UNION ALL SELECT 'orders', 'append', count(*), 2 * count(*), count(*), 'success' FROM orders"
    ),
    "content_compare": (
        "SELECT 'lineitem' AS tbl, count(*) AS source_rows, count(*) AS target_rows, true AS same_content "
        "FROM lineitem UNION ALL SELECT 'orders', count(*), count(*), true FROM orders"
    ),
    "append_partitioned": (
        "SELECT 'append' AS mode, count(*) AS source_rows, count(*) AS added_rows, "
        f"(SELECT count(*) FROM events) AS target_rows, {_COUNT_OK} FROM events WHERE CAST(ts AS DATE) = DATE '{PRUNE_DS}'"
    ),
    "migration_report": (
        "SELECT 'orders.parquet' AS src, 'orders' AS tbl, count(*) AS source_rows, count(*) AS target_rows, "
        f"{_COUNT_OK}, false AS has_error FROM orders "
        "UNION ALL SELECT 'no_such_table.parquet', 'no_such_table', NULL, NULL, 'failed', true "
        "UNION ALL SELECT 'customer.parquet', 'customer', count(*), count(*), 'success', false FROM customer"
    ),
    "migrate_subset": (
        f"SELECT 'orders' AS tbl, count(*) AS target_rows, {_COUNT_OK} FROM orders "
        "UNION ALL SELECT 'part', count(*), 'success' FROM part"
    ),
    "migration_summary": (
        "SELECT 'success' AS status, CAST(2 AS BIGINT) AS n_tables, "
        "(SELECT count(*) FROM orders) + (SELECT count(*) FROM customer) AS source_rows "
        "UNION ALL SELECT 'failed', 1, 0"
    ),
    "register_report": (
        f"SELECT 'events' AS tbl, count(*) AS source_rows, count(*) AS target_rows, {_COUNT_OK} FROM events "
        "UNION ALL SELECT 'orders', count(*), count(*), 'success' FROM orders"
    ),
    "stage_tables": (
        f"SELECT 'orders' AS name, count(*) AS n_rows, {_COUNT_OK} FROM orders "
        "UNION ALL SELECT 'lineitem', count(*), 'success' FROM lineitem"
    ),
    "stage_exports": (
        f"SELECT 'orders' AS name, '{REPLICA_DS[0]}' AS ds, count(*) AS n_rows FROM orders "
        f"UNION ALL SELECT 'orders', '{REPLICA_DS[1]}', count(*) FROM orders "
        f"UNION ALL SELECT 'customer', '{REPLICA_DS[0]}', count(*) FROM customer "
        f"UNION ALL SELECT 'customer', '{REPLICA_DS[1]}', count(*) FROM customer"
    ),
    "fused_checks": (
        "SELECT CAST(1 AS INTEGER) AS position, 'orders not empty' AS label, CASE WHEN (SELECT count(*) > 0 FROM orders) THEN 'passed' ELSE 'failed' END AS status UNION ALL "
        "SELECT CAST(2 AS INTEGER) AS position, 'orders have statuses' AS label, CASE WHEN (SELECT count(DISTINCT o_orderstatus) BETWEEN 1 AND 5 FROM orders) THEN 'passed' ELSE 'failed' END AS status UNION ALL "
        "SELECT CAST(3 AS INTEGER) AS position, 'filled orders' AS label, CASE WHEN (SELECT count(*) > 0 FROM orders WHERE o_orderstatus = 'F') THEN 'passed' ELSE 'failed' END AS status UNION ALL "
        "SELECT CAST(4 AS INTEGER) AS position, 'no negative total' AS label, CASE WHEN (SELECT count(*) = 0 FROM orders WHERE o_totalprice < 0) THEN 'passed' ELSE 'failed' END AS status UNION ALL "
        "SELECT CAST(5 AS INTEGER) AS position, 'dear orders' AS label, CASE WHEN (SELECT count(*) > 100000000 FROM orders WHERE o_totalprice > 1000) THEN 'passed' ELSE 'failed' END AS status UNION ALL "
        "SELECT CAST(6 AS INTEGER) AS position, 'items outnumber orders' AS label, CASE WHEN (SELECT count(*) FROM lineitem) > (SELECT count(*) FROM orders) THEN 'passed' ELSE 'failed' END AS status UNION ALL "
        "SELECT CAST(7 AS INTEGER) AS position, 'quantities add up' AS label, CASE WHEN (SELECT sum(l_quantity) > 0 AND min(l_discount) >= 0 FROM lineitem) THEN 'passed' ELSE 'failed' END AS status UNION ALL "
        "SELECT CAST(8 AS INTEGER) AS position, 'returned items' AS label, CASE WHEN (SELECT count(*) > 0 FROM lineitem WHERE l_returnflag = 'R') THEN 'passed' ELSE 'failed' END AS status"
    ),
    "write_replace_pointer": "SELECT * FROM lineitem",
    "append_once": "SELECT * FROM orders",
    "register_incremental": "SELECT *, CAST(coalesce(ts, TIMESTAMP '2000-01-01') AS DATE) AS ds FROM events",
    "scan_arrow": "SELECT * FROM lineitem",
    "merged_statistics": (
        "SELECT l_returnflag, count(*) AS n_rows, min(l_orderkey) AS min_l_orderkey, max(l_orderkey) AS max_l_orderkey, "
        "count(*) - count(l_orderkey) AS nulls_l_orderkey, min(l_shipdate) AS min_l_shipdate, max(l_shipdate) AS max_l_shipdate, "
        "min(l_extendedprice) AS min_l_extendedprice, max(l_extendedprice) AS max_l_extendedprice, max(l_tax) AS max_l_tax, "
        "true AS distinct_ok, true AS median_ok FROM lineitem GROUP BY l_returnflag"
    ),
    "migrate_deadline": (
        "SELECT 'customer' AS name, 'timed out' AS status, CAST(NULL AS BIGINT) AS target_rows, false AS has_table "
        "UNION ALL SELECT 'orders', 'success', count(*), true FROM orders "
        "UNION ALL SELECT 'nation', 'success', count(*), true FROM nation "
        "UNION ALL SELECT 'lineitem', 'success', count(*), true FROM lineitem"
    ),
    "scan_reconciled": (
        "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, "
        "CASE WHEN o_orderstatus = 'P' THEN CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) ELSE o_totalprice END AS o_totalprice, "
        "o_orderdate, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders"
    ),
    "limit_rows_parallel": "SELECT CASE WHEN count(*) < 10000 THEN count(*) ELSE 10000 END AS n_rows, CAST(0 AS BIGINT) AS n_foreign FROM lineitem",
    "content_difference": (
        "WITH other AS (SELECT * REPLACE (CASE WHEN l_orderkey % 97 = 2 AND l_returnflag = 'R' THEN 9.5::DOUBLE ELSE l_tax END AS l_tax) "
        "FROM lineitem WHERE l_orderkey % 97 <> 1 OR l_returnflag <> 'R' "
        "UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 97 = 3 AND l_returnflag = 'R') "
        "SELECT 'left' AS side, * FROM (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM other) "
        "UNION ALL SELECT 'right', * FROM (SELECT * FROM other EXCEPT ALL SELECT * FROM lineitem)"
    ),
}
