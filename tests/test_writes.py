import os

import pytest
from pyspark.sql import functions as F

from carryover.operators import fingerprint, load_overwrite, write_table
from conftest import SF001


def _files(spark, table):
    loc = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()[1]
    path = loc.replace("file:", "")
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]


def test_create_counts_and_refuses_existing(spark, db):
    df = spark.read.parquet(f"{SF001}/orders.parquet")
    w = write_table(df, f"{db}.o", "create")
    assert w.rows == df.count() == spark.table(f"{db}.o").count()
    with pytest.raises(Exception, match="(?i)already exists"):
        write_table(df, f"{db}.o", "create")


def test_append_needs_existing_table_and_same_partitioning(spark, db):
    df = spark.read.parquet(f"{SF001}/nation.parquet")
    with pytest.raises(ValueError, match="does not exist"):
        write_table(df, f"{db}.n", "append")
    assert not spark.catalog.tableExists(f"{db}.n")  # V1 append would have created it
    write_table(df, f"{db}.n", "create", partition_by=["n_regionkey"])
    with pytest.raises(ValueError, match="partitioned by"):
        write_table(df, f"{db}.n", "append", partition_by=["n_name"])
    w = write_table(df.select(*reversed(df.columns)), f"{db}.n", "append")  # by name, any order
    assert w.rows == 25
    assert spark.table(f"{db}.n").count() == 50
    assert spark.table(f"{db}.n").exceptAll(df.unionByName(df)).count() == 0


def test_replace_swaps_schema_and_rows(spark, db):
    nation = spark.read.parquet(f"{SF001}/nation.parquet")
    region = spark.read.parquet(f"{SF001}/region.parquet")
    write_table(nation, f"{db}.r", "create")
    write_table(region, f"{db}.r", "replace")
    got = spark.table(f"{db}.r")
    assert got.columns == region.columns
    assert got.exceptAll(region).count() == 0 and region.exceptAll(got).count() == 0


def test_repartition_gives_that_many_files(spark, db):
    df = spark.read.parquet(f"{SF001}/orders.parquet")
    write_table(df, f"{db}.o3", "create", repartition=3)
    assert len(_files(spark, f"{db}.o3")) == 3


def test_partitioned_write_is_clustered_and_moves_columns_last(spark, db):
    df = spark.read.parquet(f"{SF001}/lineitem.parquet")
    write_table(df, f"{db}.li", "create", partition_by=["l_returnflag"])
    got = spark.table(f"{db}.li")
    assert got.columns[-1] == "l_returnflag"
    files = _files(spark, f"{db}.li")
    values = {p.split("l_returnflag=")[1].split("/")[0] for p in files}
    # rebalanced on the partition column: one file per value at this size, not tasks x values
    assert len(files) == len(values) == df.select("l_returnflag").distinct().count()
    assert got.select(*df.columns).exceptAll(df).count() == 0


def test_rebalance_in_plan_only_when_needed(spark):
    from carryover.operators import prepare_for_write

    df = spark.read.parquet(f"{SF001}/lineitem.parquet")
    plan = prepare_for_write(df, partition_by=["l_returnflag"])._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan
    same = prepare_for_write(df, partition_by=["ds"], input_partition_columns=["ds", "hour"])
    assert "RebalancePartitions" not in same._jdf.queryExecution().optimizedPlan().toString()


def test_fingerprint_sees_a_changed_value(spark, db):
    df = spark.read.parquet(f"{SF001}/orders.parquet")
    w = write_table(df, f"{db}.fp", "create", fingerprint=True)
    assert w.fingerprint == fingerprint(spark.table(f"{db}.fp"), df.columns)
    changed = df.withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") == df.first()["o_orderkey"], F.lit(-1.0)).otherwise(F.col("o_totalprice"))
    )
    assert fingerprint(changed)["rows"] == w.rows
    assert fingerprint(changed)["hash_sum"] != w.fingerprint["hash_sum"]
    # a duplicated row changes it as well (it is a sum, not a set)
    assert fingerprint(df.unionByName(df.limit(1)))["hash_sum"] != w.fingerprint["hash_sum"]


def test_nested_and_map_types_copy(spark, db):
    df = spark.sql(
        "SELECT 1L AS id, named_struct('a b', 1, 'c', array(1.5D, 2.5D)) AS s, map('k', 1) AS m, "
        "CAST(12.34 AS DECIMAL(10,2)) AS d"
    )
    w = write_table(df, f"{db}.nested", "create", fingerprint=True)
    assert w.rows == 1
    assert fingerprint(spark.table(f"{db}.nested"), df.columns) == w.fingerprint


def test_load_overwrite_with_cap(spark, db):
    df = spark.read.parquet(f"{SF001}/lineitem.parquet")
    assert load_overwrite(df, f"{db}.cap", max_rows=100) == 100
    assert load_overwrite(df, f"{db}.cap") == df.count()


def test_empty_table_copies(spark, db):
    df = spark.read.parquet(f"{SF001}/orders.parquet").where("false")
    w = write_table(df, f"{db}.empty", "create", fingerprint=True)
    assert w.rows == 0 and spark.table(f"{db}.empty").count() == 0


def test_hot_partition_value_is_split_across_tasks(spark, db):
    """One value holding most rows must not become one straggler task/file."""
    df = (
        spark.read.parquet(f"{SF001}/lineitem.parquet")
        .repartition(8)  # many input splits, as any large table has
        .withColumn("flag", F.when(F.col("l_orderkey") % 10 < 6, F.lit("HOT")).otherwise(F.col("l_returnflag")))
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        w = write_table(df, f"{db}.skew", "create", partition_by=["flag"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = _files(spark, f"{db}.skew")
    hot = [f for f in files if "flag=HOT" in f]
    assert len(hot) > 1
    assert w.rows == df.count() == spark.table(f"{db}.skew").count()


def _jobs_in(spark, group, fn):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return sc.statusTracker().getJobIdsForGroup(group)


def test_copy_reads_the_source_once(spark, db):
    """The count comes from the write's own Observation: one job, no separate count scan."""
    df = spark.read.parquet(f"{SF001}/orders.parquet")
    jobs = _jobs_in(spark, "copy-once", lambda: write_table(df, f"{db}.once", "create"))
    assert len(jobs) == 1
    stages = spark.sparkContext.statusTracker().getJobInfo(jobs[0]).stageIds
    assert len(stages) == 1  # scan and write pipelined in one stage


def test_fingerprint_pair_matches_single_fingerprints(spark, db):
    from carryover.operators import fingerprint_pair

    df = spark.read.parquet(f"{SF001}/orders.parquet")
    write_table(df, f"{db}.pair", "create", partition_by=["o_orderstatus"])
    copy = spark.table(f"{db}.pair")  # partition column moved last: matched by name
    a, b = fingerprint_pair(df, copy)
    assert a == b == fingerprint(df)
    c, d = fingerprint_pair(df, copy.where("o_orderkey % 7 <> 0"))
    assert c["rows"] > d["rows"] and c["hash_sum"] != d["hash_sum"]
    e, f = fingerprint_pair(df, df.where("false"))
    assert f == {"rows": 0, "hash_sum": 0}


def test_content_check_survives_type_widening_on_append(spark, db):
    from carryover.plans import MigrationOptions, migrate_table
    from carryover.sources import CatalogSource

    spark.sql("SELECT CAST(id AS BIGINT) AS id, CAST(id AS DOUBLE) AS v FROM range(5)").write.saveAsTable(f"{db}.wide")
    spark.sql("SELECT CAST(id AS INT) AS id, CAST(id AS FLOAT) AS v FROM range(5, 8)").write.saveAsTable(f"{db}.narrow")
    row = migrate_table(
        spark, CatalogSource(database=db), "narrow", MigrationOptions(database=db, mode="append", verify="content"),
        target_name="wide",
    )
    assert (row["status"], row["added_rows"]) == ("success", 3), row


def test_lossy_append_is_a_content_mismatch(spark, db):
    from carryover.plans import MigrationOptions, migrate_table
    from carryover.sources import CatalogSource

    spark.sql("SELECT CAST(id AS FLOAT) AS v FROM range(3)").write.saveAsTable(f"{db}.f32")
    spark.sql("SELECT CAST(id AS DOUBLE) + 0.1D AS v FROM range(3)").write.saveAsTable(f"{db}.f64")
    row = migrate_table(
        spark, CatalogSource(database=db), "f64", MigrationOptions(database=db, mode="append", verify="content"),
        target_name="f32",
    )
    assert row["status"] == "mismatch" and row["added_rows"] == 3


def test_widening_rules():
    from pyspark.sql.types import ByteType, DecimalType, DoubleType, FloatType, IntegerType, LongType

    from carryover.operators.validate import widens

    assert widens(IntegerType(), LongType()) and widens(FloatType(), DoubleType()) and widens(ByteType(), IntegerType())
    assert widens(DecimalType(10, 2), DecimalType(12, 4)) and widens(IntegerType(), DecimalType(12, 2))
    assert not widens(LongType(), IntegerType()) and not widens(DoubleType(), FloatType())
    assert not widens(DecimalType(12, 4), DecimalType(10, 2)) and not widens(LongType(), DoubleType())
    assert not widens(IntegerType(), DecimalType(10, 2))


@pytest.mark.parametrize(
    "expr",
    [
        "INTERVAL '1 02:03:04' DAY TO SECOND",
        "INTERVAL '1-2' YEAR TO MONTH",
        "CAST('ab' AS BINARY)",
        "array(named_struct('x', 1, 'y', 'z'))",
        "map('k', array(1, 2))",
        "named_struct('m', map('a', 1))",
        "parse_json('{\"a\": 1}')",
        "TIMESTAMP '2024-01-01 00:00:00'",
    ],
)
def test_every_column_type_fingerprints(spark, db, expr):
    import re

    df = spark.sql(f"SELECT id, {expr} AS c FROM range(3)")
    name = "ty_" + re.sub(r"\W", "", expr)[:20].lower()
    w = write_table(df, f"{db}.{name}", "create", fingerprint=True)
    assert fingerprint(spark.table(f"{db}.{name}"), df.columns) == w.fingerprint


def test_describe_table_reads_partitioning(spark, db):
    from carryover.operators.write import describe_table

    df = spark.read.parquet(f"{SF001}/lineitem.parquet")
    write_table(df, f"{db}.two", "create", partition_by=["l_returnflag", "l_linestatus"])
    info = describe_table(spark, f"{db}.two")
    assert info.partition_columns == ("l_returnflag", "l_linestatus")
    assert info.provider == "parquet" and info.location.endswith("/two")
    write_table(df, f"{db}.flat", "create")
    assert describe_table(spark, f"{db}.flat").partition_columns == ()


def test_describe_table_with_spaced_partition_column(spark, db):
    from carryover.operators.write import describe_table

    df = spark.sql("SELECT id, CAST(id % 2 AS STRING) AS `event kind` FROM range(6)")
    write_table(df, f"{db}.spaced", "create", partition_by=["event kind"])
    assert describe_table(spark, f"{db}.spaced").partition_columns == ("event kind",)
    w = write_table(df, f"{db}.spaced", "append")
    assert w.rows == 6 and spark.table(f"{db}.spaced").count() == 12


def test_v2_writer_branch_create(spark, db, monkeypatch):
    """The DataFrameWriterV2 branch (used for Iceberg catalogs), driven through the session catalog."""
    import carryover.operators.write as w

    monkeypatch.setattr(w, "is_v1_target", lambda *a, **k: False)
    df = spark.read.parquet(f"{SF001}/orders.parquet")
    res = w.write_table(df, f"spark_catalog.{db}.v2", "create", partition_by=["o_orderstatus"], fingerprint=True)
    assert res.rows == df.count()
    got = spark.table(f"{db}.v2")
    assert got.columns[-1] == "o_orderstatus"
    assert fingerprint(got, df.columns) == res.fingerprint


def test_staged_replace_keeps_the_old_table_on_failure_and_can_read_itself(spark, db):
    nation = spark.read.parquet(f"{SF001}/nation.parquet")
    write_table(nation, f"{db}.st", "create")
    bad = nation.withColumn("n_nationkey", F.expr("assert_true(n_nationkey < 0)"))  # fails at run time
    with pytest.raises(Exception):
        write_table(bad, f"{db}.st", "replace", staged=True)
    assert spark.table(f"{db}.st").count() == 25  # untouched
    assert [t.name for t in spark.catalog.listTables(db) if "staging" in t.name] == []
    # replace a table from its own rows, which plain V1 overwrite refuses
    w = write_table(spark.table(f"{db}.st").where("n_regionkey = 1"), f"{db}.st", "replace", staged=True)
    assert w.rows == spark.table(f"{db}.st").count() == 5


def test_replace_is_staged_by_default_and_a_lost_table_comes_back(spark, db):
    from carryover.operators.write import restore_replaced

    nation = spark.read.parquet(f"{SF001}/nation.parquet")
    write_table(nation, f"{db}.safe", "create")
    bad = nation.withColumn("n_nationkey", F.expr("assert_true(n_nationkey < 0)"))
    with pytest.raises(Exception):
        write_table(bad, f"{db}.safe", "replace")
    assert spark.table(f"{db}.safe").count() == 25
    # a driver that died between the renames: the name has no table, the old one lies beside it
    spark.sql(f"ALTER TABLE {db}.safe SET TBLPROPERTIES ('carryover.replaced' = '0a0b0c0d')")
    spark.sql(f"ALTER TABLE {db}.safe RENAME TO {db}.safe__replaced_0a0b0c0d")
    with pytest.raises(Exception):
        write_table(bad, f"{db}.safe", "replace")
    assert spark.table(f"{db}.safe").count() == 25
    assert not restore_replaced(spark, f"{db}.safe") and not restore_replaced(spark, f"{db}.never_there")


def test_v2_targets_get_no_clustering_of_ours(spark, monkeypatch):
    from carryover.operators import write

    seen = {}
    monkeypatch.setattr(write, "is_v1_target", lambda *a: False)
    monkeypatch.setattr(write, "prepare_for_write", lambda df, **kw: seen.update(kw) or df)
    with pytest.raises(Exception):
        write_table(spark.range(3), "no_such_catalog.db.t", "create", partition_by=["id"])
    assert seen["cluster"] == "none"


def test_v2_registration_is_held_against_what_was_added():
    from carryover.operators.register import Registered

    row = dict(table="t", path="p", layout=None, source_rows=3, target_rows=10, rows_before=7)
    assert Registered(**row, adds=True).status == "success"
    assert Registered(**row).status == "mismatch"


def test_staged_replace_through_a_batch_with_three_part_names(spark, db):
    from carryover.plans import MigrationOptions, migrate_table
    from carryover.sources import ParquetSource

    ref = f"{SF001}/region.parquet"
    opts = MigrationOptions(database=db)
    migrate_table(spark, ParquetSource(), ref, opts, target_name="reg3")
    row = migrate_table(
        spark, ParquetSource(), f"{SF001}/nation.parquet", MigrationOptions(database=db, mode="replace", staged_replace=True),
        target_name="reg3",
    )
    assert (row["status"], row["target_rows"]) == ("success", 25), row
    names = [t.name for t in spark.catalog.listTables(db)]
    assert "reg3" in names and not [n for n in names if "__" in n]


def test_auto_repartition_compacts_small_files(spark, db, scratch):
    path = scratch("small")
    spark.read.parquet(f"{SF001}/orders.parquet").repartition(12).write.parquet(path)  # 12 small files
    df = spark.read.parquet(path)
    w = write_table(df, f"{db}.compact", "create", repartition="auto")
    assert w.rows == df.count()
    assert len(_files(spark, f"{db}.compact")) < 12
    plan = df.hint("rebalance")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def test_auto_repartition_refuses_without_aqe(spark, db):
    from carryover.operators import prepare_for_write

    df = spark.read.parquet(f"{SF001}/region.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(ValueError, match="adaptive"):
            prepare_for_write(df, repartition="auto")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_failed_create_leaves_nothing_and_can_be_rerun(spark, db):
    nation = spark.read.parquet(f"{SF001}/nation.parquet")
    bad = nation.withColumn("n_nationkey", F.expr("assert_true(n_nationkey < 0)"))
    with pytest.raises(Exception):
        write_table(bad, f"{db}.retry", "create")
    assert not spark.catalog.tableExists(f"{db}.retry")
    assert write_table(nation, f"{db}.retry", "create").rows == 25


def test_tables_of_others_are_not_taken_for_replaced_ones(spark, db):
    from carryover.operators.write import restore_replaced

    nation = spark.read.parquet(f"{SF001}/nation.parquet")
    for name in ("mine__replaced_old", "mine__replaced_0a0b0c0d", "mine__replaced_00000000"):
        write_table(nation, f"{db}.{name}", "create")
    spark.sql(f"ALTER TABLE {db}.mine__replaced_00000000 SET TBLPROPERTIES ('carryover.replaced' = '11111111')")
    assert not restore_replaced(spark, f"{db}.mine")
    for mode in ("append", "replace"):
        if mode == "append":
            with pytest.raises(ValueError, match="does not exist"):
                write_table(nation.limit(2), f"{db}.mine", mode)
        else:
            write_table(nation.limit(2), f"{db}.mine", mode)
    assert spark.table(f"{db}.mine").count() == 2 and spark.table(f"{db}.mine__replaced_old").count() == 25
    # one that a replace did put aside is still no target of an append
    spark.sql(f"ALTER TABLE {db}.mine__replaced_00000000 SET TBLPROPERTIES ('carryover.replaced' = '00000000')")
    spark.sql(f"DROP TABLE {db}.mine")
    with pytest.raises(ValueError, match="does not exist"):
        write_table(nation, f"{db}.mine", "append")
    assert restore_replaced(spark, f"{db}.mine") and spark.table(f"{db}.mine").count() == 25


def _folders(spark, db, name):
    import os

    from carryover.operators.write import describe_table

    home = os.path.dirname(describe_table(spark, f"{db}.{name}").location.replace("file:", ""))
    return sorted(f for f in os.listdir(home) if f == name or f.startswith(f"{name}__v_"))


@pytest.mark.parametrize("parts", [[], ["o_orderstatus"], ["o_orderstatus", "o_orderpriority"]])
def test_pointer_replace_switches_versions(spark, db, parts):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    blank = F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_orderstatus"))
    first = orders.withColumn("o_orderstatus", F.concat(F.col("o_orderstatus"), F.lit(" a/b='x'%")))
    write_table(first, f"{db}.ptr", "create", partition_by=parts)
    renames = []
    real = spark.sql

    def watched(text, *args, **kwargs):
        renames.append(text) if "RENAME" in text else None
        return real(text, *args, **kwargs)

    spark.sql = watched
    try:
        second = orders.withColumn("o_orderstatus", blank)
        done = write_table(second, f"{db}.ptr", "replace", partition_by=parts, staged="pointer", fingerprint=True)
    finally:
        del spark.sql
    assert not renames and done.rows == second.count()
    got = spark.table(f"{db}.ptr").select(*orders.columns)
    assert got.exceptAll(second).isEmpty() and second.exceptAll(got).isEmpty()
    assert len(_folders(spark, db, "ptr")) == 1  # the old version is gone
    if parts:
        values = {r[0] for r in spark.sql(f"SHOW PARTITIONS {db}.ptr").collect()}
        assert len(values) == second.select(*parts).distinct().count()
    # from its own rows; then a failure that leaves it alone
    write_table(spark.table(f"{db}.ptr").where("o_orderkey % 2 = 0").select(*orders.columns), f"{db}.ptr", "replace", staged="pointer")
    half = second.where("o_orderkey % 2 = 0").count()
    assert spark.table(f"{db}.ptr").count() == half
    bad = second.withColumn("o_custkey", F.expr("assert_true(o_custkey < 0)").cast("long"))
    with pytest.raises(Exception):
        write_table(bad, f"{db}.ptr", "replace", staged="pointer")
    assert spark.table(f"{db}.ptr").count() == half and len(_folders(spark, db, "ptr")) == 1
    write_table(second, f"{db}.ptr", "append")
    assert spark.table(f"{db}.ptr").count() == half + second.count()


def test_pointer_replace_of_other_columns_and_of_registered_files(spark, db, scratch):
    import os

    nation, region = (spark.read.parquet(f"{SF001}/{n}.parquet") for n in ("nation", "region"))
    write_table(nation, f"{db}.shape", "create")
    assert write_table(region, f"{db}.shape", "replace", staged="pointer").rows == 5  # by renames
    assert spark.table(f"{db}.shape").columns == region.columns
    path = scratch("registered")
    nation.write.parquet(path)
    spark.sql(f"CREATE TABLE {db}.outside USING parquet LOCATION '{path}'")
    write_table(nation.limit(3), f"{db}.outside", "replace", staged="pointer")
    assert spark.table(f"{db}.outside").count() == 3
    assert spark.read.parquet(path).count() == 25 and os.path.isdir(path.replace("file:", ""))  # not ours to remove


def test_a_failed_load_keeps_the_old_rows(spark, db):
    from carryover.operators import load_overwrite

    nation = spark.read.parquet(f"{SF001}/nation.parquet")
    assert load_overwrite(nation, f"{db}.loaded") == 25
    with pytest.raises(Exception):
        load_overwrite(nation.withColumn("n_nationkey", F.expr("assert_true(n_nationkey < 0)").cast("int")), f"{db}.loaded")
    assert spark.table(f"{db}.loaded").count() == 25
    assert load_overwrite(nation.where("n_nationkey < 4"), f"{db}.loaded") == 4
    assert load_overwrite(nation.select("n_name"), f"{db}.loaded") == 25
