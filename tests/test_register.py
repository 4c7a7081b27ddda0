import os

import pytest
from pyspark.sql import functions as F

from carryover.operators import export_partitioned, infer_layout, register_files
from carryover.sources import read_parquet
from conftest import SF001


def _events(spark):
    return spark.read.parquet(f"{SF001}/events.parquet").withColumn("ds", F.date_format("ts", "yyyy-MM-dd"))


def test_register_roundtrip_prunes_and_is_idempotent(spark, db, scratch):
    path = scratch("ev")
    ex = export_partitioned(_events(spark), path, ["ds"])
    reg = register_files(spark, path, f"{db}.ev", partition_columns=["ds"])
    assert reg.status == "success" and reg.source_rows == ex.rows == 1000
    t = spark.table(f"{db}.ev")
    assert dict(t.dtypes)["ds"] == "date"
    pruned = t.where("ds = '2024-01-15'")
    assert len(pruned.inputFiles()) == 1  # one directory listed and read
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    # files are not rewritten: the table points at the exported directory
    assert all(f.replace("file://", "").replace("file:", "").startswith(path) for f in t.inputFiles())
    # re-running is harmless, and a new partition shows up after it
    extra = _events(spark).where("ds = '2024-01-01'").withColumn("ds", F.lit("2030-01-01"))
    extra.write.mode("append").partitionBy("ds").parquet(path)
    again = register_files(spark, path, f"{db}.ev")
    assert again.status == "success" and again.target_rows == 1000 + extra.count()


def test_partition_types_and_wrong_columns(spark, db, scratch):
    path = scratch("ev")
    export_partitioned(_events(spark), path, ["ds"])
    layout = infer_layout(spark, path, partition_types={"ds": "string"})
    assert layout.partition_columns == ("ds",)
    assert layout.schema["ds"].dataType.simpleString() == "string"
    with pytest.raises(ValueError, match="directory layout"):
        register_files(spark, path, f"{db}.bad", partition_columns=["event_type"])
    reg = register_files(spark, path, f"{db}.s", partition_types={"ds": "string"})
    assert dict(spark.table(f"{db}.s").dtypes)["ds"] == "string" and reg.status == "success"


def test_existing_table_with_other_columns_is_refused(spark, db, scratch):
    path = scratch("ev")
    export_partitioned(_events(spark), path, ["ds"])
    spark.sql(f"CREATE TABLE {db}.taken (x INT) USING parquet")
    with pytest.raises(ValueError, match="different columns"):
        register_files(spark, path, f"{db}.taken")


def test_unpartitioned_directory(spark, db, scratch):
    path = scratch("plain")
    df = spark.read.parquet(f"{SF001}/customer.parquet")
    df.write.parquet(path)
    reg = register_files(spark, path, f"{db}.cust")
    assert reg.layout.partition_columns == () and reg.status == "success"
    assert reg.target_rows == df.count()


def test_null_partition_and_nested_names(spark, db, scratch):
    path = scratch("nul")
    df = spark.sql(
        "SELECT * FROM VALUES (1, named_struct('a b', 1), 'x'), (2, named_struct('a b', 2), NULL) AS t(id, s, p)"
    )
    export_partitioned(df, path, ["p"])
    reg = register_files(spark, path, f"{db}.nul")
    assert reg.status == "success"
    got = {r["id"]: r["p"] for r in spark.table(f"{db}.nul").collect()}
    assert got == {1: "x", 2: None}


def test_merge_schema_reads_columns_of_all_files(spark, scratch):
    path = scratch("ms")
    spark.sql("SELECT 1 AS a").write.parquet(f"{path}/k=1")
    spark.sql("SELECT 2 AS a, 'x' AS b").write.parquet(f"{path}/k=2")
    merged = read_parquet(spark, path, merge_schema=True)
    assert set(merged.columns) == {"a", "b", "k"}
    assert merged.where("k = 1").select("b").first()["b"] is None


def test_glob_below_root_keeps_partition_column(spark, scratch):
    path = scratch("glob")
    export_partitioned(_events(spark), path, ["ds"])
    df = read_parquet(spark, f"{path}/ds=2024-01-1*", base_path=path)
    assert "ds" in df.columns and df.select("ds").distinct().count() == 10
    assert os.path.isdir(path)


def test_partition_column_also_stored_in_files(spark, db, scratch):
    path = scratch("dup")
    ev = _events(spark)
    for d in ("2024-01-15", "2024-01-16"):
        ev.where(F.col("ds") == d).write.parquet(f"{path}/ds={d}")  # ds inside the files too
    reg = register_files(spark, path, f"{db}.dup")
    assert reg.layout.partition_columns == ("ds",) and reg.status == "success"
    t = spark.table(f"{db}.dup")
    assert [c.name for c in spark.catalog.listColumns(f"{db}.dup") if c.isPartition] == ["ds"]
    assert len(t.where("ds = '2024-01-15'").inputFiles()) == 1
    assert t.where("ds = '2024-01-15'").count() == ev.where("ds = '2024-01-15'").count()


def test_two_level_layout_with_inner_key_in_files(spark, db, scratch):
    path = scratch("two")
    ev = _events(spark).withColumn("kind", F.col("event_type"))
    ev.write.partitionBy("ds").parquet(path + "/tmp_unused")  # unrelated sibling tree
    for d in ("2024-01-15", "2024-01-16"):
        part = ev.where(F.col("ds") == d)
        for k in [r[0] for r in part.select("kind").distinct().collect()]:
            part.where(F.col("kind") == k).drop("ds").write.parquet(f"{path}/main/ds={d}/kind={k}")
    reg = register_files(spark, f"{path}/main", f"{db}.two")
    assert reg.layout.partition_columns == ("ds", "kind") and reg.status == "success"


def test_path_with_quote_and_space_registers(spark, db, scratch):
    from carryover.sources import scan_path_sql

    path = scratch("it's a dir") + "/raw data"
    export_partitioned(_events(spark), path, ["ds"])
    reg = register_files(spark, path, f"{db}.quoted")
    assert reg.status == "success" and reg.target_rows == 1000
    assert scan_path_sql(spark, path).count() == 1000


def test_existing_table_elsewhere_is_refused(spark, db, scratch):
    first, second = scratch("one"), scratch("two")
    export_partitioned(_events(spark), first, ["ds"])
    export_partitioned(_events(spark), second, ["ds"])
    assert register_files(spark, first, f"{db}.moved").status == "success"
    assert register_files(spark, first, f"{db}.moved").status == "success"  # same folder again: fine
    with pytest.raises(ValueError, match="exists over"):
        register_files(spark, second, f"{db}.moved")


def test_single_file_registers(spark, db, scratch):
    import glob

    d = scratch("single")
    spark.read.parquet(f"{SF001}/customer.parquet").coalesce(1).write.parquet(d)
    f = glob.glob(d + "/*.parquet")[0]
    reg = register_files(spark, f, f"{db}.one")
    assert reg.status == "success" and reg.target_rows == 150


def test_partition_types_survive_content_verification(spark, db, scratch):
    from carryover.operators import fingerprint_pair

    path = scratch("pt")
    export_partitioned(_events(spark), path, ["ds"])
    reg = register_files(spark, path, f"{db}.pt", partition_types={"ds": "string"})
    assert dict(reg.files.dtypes)["ds"] == "string"
    a, b = fingerprint_pair(reg.files, spark.table(f"{db}.pt"))
    assert a == b


def test_failed_export_leaves_no_data_files(spark, scratch):
    import glob

    path = scratch("failexp")
    bad = _events(spark).withColumn("event_id", F.expr("assert_true(event_id < 0)"))
    with pytest.raises(Exception):
        export_partitioned(bad, path, ["ds"])
    assert glob.glob(f"{path}/**/*.parquet", recursive=True) == []


def test_registration_interrupted_after_create_finishes_on_rerun(spark, db, scratch):
    from carryover.operators import create_table_sql, infer_layout
    from carryover.sources import qualified_path

    path = scratch("half")
    export_partitioned(_events(spark), path, ["ds"])
    qpath = qualified_path(spark, path)
    spark.sql(create_table_sql(f"{db}.half", infer_layout(spark, qpath), fmt="parquet", location=qpath))
    assert spark.table(f"{db}.half").count() == 0  # table made, partitions not yet registered
    reg = register_files(spark, path, f"{db}.half")
    assert reg.status == "success" and reg.target_rows == 1000
