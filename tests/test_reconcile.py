"""Trees whose files disagree on columns and types, read as one."""

import pytest
from pyspark.sql import types as T

from carryover.plans import MigrationOptions, run_migration
from carryover.sources import ParquetSource, SchemaConflict, common_type, get_source, read_reconciled
from carryover.sources.reconcile import file_layouts, layout_groups, partition_fields


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("int", "bigint", "bigint"),
        ("tinyint", "smallint", "smallint"),
        ("int", "string", "string"),
        ("int", "double", "double"),
        ("bigint", "double", "string"),  # 2**53 + 1 is no double
        ("float", "double", "double"),
        ("int", "decimal(5,2)", "decimal(12,2)"),
        ("decimal(38,0)", "decimal(38,10)", "string"),
        ("date", "timestamp", "timestamp"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("boolean", "int", "string"),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("map<string,int>", "map<string,string>", "map<string,string>"),
        ("struct<a:int,b:string>", "struct<c:date,A:bigint>", "struct<a:bigint,b:string,c:date>"),
        ("void", "int", "int"),
    ],
)
def test_common_type_loses_nothing_and_is_symmetric(spark, a, b, want):
    left, right = T._parse_datatype_string(a), T._parse_datatype_string(b)
    assert common_type(left, right).simpleString() == want
    assert common_type(right, left).simpleString().lower().count("bigint") == want.count("bigint")


@pytest.mark.parametrize("a, b", [("array<int>", "int"), ("binary", "string"), ("struct<a:int>", "map<string,int>")])
def test_types_without_a_common_one_are_a_conflict(spark, a, b):
    with pytest.raises(SchemaConflict):
        common_type(T._parse_datatype_string(a), T._parse_datatype_string(b))


def _three(spark, root):
    spark.sql("SELECT CAST(id AS INT) AS k, CAST(id AS STRING) AS v FROM range(5)").write.parquet(f"{root}/ds=2024-01-01")
    spark.sql("SELECT id + 3000000000 AS K, id AS v FROM range(5)").write.parquet(f"{root}/ds=2024-01-02")
    spark.sql("SELECT 'x' AS extra, CAST(id AS INT) AS k FROM range(5)").write.parquet(f"{root}/ds=oops")


def test_three_layouts_as_one(spark, scratch):
    root = scratch("rec")
    _three(spark, root)
    with pytest.raises(Exception):  # what this is for
        spark.read.option("mergeSchema", "true").parquet(root).collect()
    df = read_reconciled(spark, root)
    assert df.dtypes == [("k", "bigint"), ("v", "string"), ("extra", "string"), ("ds", "string")]
    rows = {(r["k"], r["v"], r["extra"], r["ds"]) for r in df.collect()}
    assert rows == (
        {(i, str(i), None, "2024-01-01") for i in range(5)}
        | {(i + 3_000_000_000, str(i), None, "2024-01-02") for i in range(5)}
        | {(i, None, "x", "oops") for i in range(5)}
    )


def test_filters_and_pruning_reach_every_scan(spark, scratch):
    root = scratch("rec")
    _three(spark, root)
    plan = read_reconciled(spark, root).where("ds = 'oops' AND k > 2").select("k")._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("FileScan parquet") == 3
    assert physical.count("ds#") and physical.count("PartitionFilters: [isnotnull(ds") == 3
    assert "ReadSchema: struct<k:int>" in physical and "extra" not in physical
    assert physical.count("GreaterThan(k,2)") + physical.count("GreaterThan(K,2)") == 3  # also where k is widened


def test_layouts_within_one_folder_and_folders_within_folders(spark, scratch):
    root = scratch("rec")
    spark.range(3).selectExpr("CAST(id AS INT) AS a").coalesce(1).write.parquet(root)
    spark.range(3).selectExpr("id AS a").coalesce(1).write.mode("append").parquet(root)
    spark.range(3).selectExpr("CAST(id AS STRING) AS a").coalesce(1).write.parquet(f"{root}/deep [1]")
    groups = layout_groups(spark, root)
    assert sorted(g.n_files for g in groups) == [1, 1, 1]
    assert sorted(r["a"] for r in read_reconciled(spark, root).collect()) == ["0", "0", "0", "1", "1", "1", "2", "2", "2"]


def test_one_layout_is_read_by_its_folders(spark, scratch):
    root = scratch("rec")
    spark.range(100).selectExpr("id", "id % 4 AS p").repartition(5).write.partitionBy("p").parquet(root)
    (group,) = layout_groups(spark, root)
    assert len(group.paths) == 4 and group.n_files == file_layouts(spark, root).count()
    df = read_reconciled(spark, root)
    assert df.count() == 100 and "Union" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert [f.simpleString() for f in partition_fields(spark, root)] == ["p:int"]


def test_nested_fields_are_joined_by_name_and_nulls_stay_null(spark, scratch):
    root = scratch("rec")
    spark.sql("SELECT CASE WHEN id > 0 THEN named_struct('x', CAST(id AS INT), 'z', true) END AS s FROM range(2)").write.parquet(root)
    spark.sql("SELECT named_struct('y', array(id), 'x', id) AS s FROM range(1)").write.mode("append").parquet(root)
    rows = [r["s"] and (r["s"]["x"], r["s"]["y"], r["s"]["z"]) for r in read_reconciled(spark, root).collect()]
    assert sorted(rows, key=str) == [(0, [0], None), (1, None, True), None]


def test_a_column_stored_in_files_and_named_by_folders(spark, scratch):
    root = scratch("rec")
    spark.range(2).selectExpr("id", "'in file' AS ds").write.parquet(f"{root}/ds=a")
    spark.range(2).selectExpr("CAST(id AS INT) AS id").write.parquet(f"{root}/ds=b")
    assert {(r["id"], r["ds"]) for r in read_reconciled(spark, root).collect()} == {(0, "a"), (1, "a"), (0, "b"), (1, "b")}


def test_migrating_a_reconciled_tree(spark, db, scratch):
    root = scratch("rec")
    _three(spark, root)
    source = get_source("parquet", reconcile="yes")
    opts = MigrationOptions(database=db, verify="content", partition_by=("ds",))
    rep = run_migration(spark, source, [root], opts, targets={root: "rec"}).first()
    assert (rep["status"], rep["source_rows"], rep["target_rows"]) == ("success", 15, 15), rep
    rep = run_migration(spark, source, [root], MigrationOptions(database=db, mode="register"), targets={root: "r2"}).first()
    assert rep["status"] == "failed" and "copy them" in rep["error"]


def test_no_files_is_an_error(spark, scratch):
    root = scratch("rec")
    spark.range(1).write.parquet(f"{root}/a=1")
    spark.range(1).where("false").write.parquet(f"{root}/a=2")  # a file without rows
    assert read_reconciled(spark, root).count() == 1
    with pytest.raises(Exception):
        read_reconciled(spark, scratch("nothing"))
    assert isinstance(ParquetSource(reconcile=True), ParquetSource)
