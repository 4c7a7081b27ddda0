import pytest
from pyspark.sql import functions as F

from carryover.operators import export_partitioned, partition_stats, replicate_partitions, tag_partition
from carryover.plans import MigrationOptions, migrate_table, plan_targets, run_migration, select_tables, summarize
from carryover.sources import CatalogSource, ParquetSource
from conftest import SF001


def test_export_append_reports_rows_added_per_partition(spark, scratch):
    path = scratch("exp")
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    first = export_partitioned(replicate_partitions(orders, "ds", ["2024-01-15", "2024-01-16"]), path, ["ds"])
    assert first.rows == 2 * orders.count()
    second = export_partitioned(tag_partition(orders, "ds", "2024-01-16"), path, ["ds"])
    per = {str(r["ds"]): r["n_rows"] for r in second.partitions.collect()}
    assert per == {"2024-01-16": orders.count()}  # only what this run added
    assert spark.read.parquet(path).count() == 3 * orders.count()  # re-running appends


def test_file_stats_rollup(spark, scratch):
    path = scratch("fs")
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    orders.repartition(4).write.partitionBy("o_orderstatus").parquet(path)
    stats = partition_stats(spark.read.parquet(path), ["o_orderkey"], ["o_orderstatus"])
    want = orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("min_o_orderkey")
    )
    got = stats.select("o_orderstatus", "n_rows", "min_o_orderkey")
    assert got.exceptAll(want).count() == 0
    assert all(r["n_files"] >= 1 for r in stats.collect())


def test_batch_isolates_failures_and_collisions(spark, db):
    refs = [f"{SF001}/orders.parquet", f"{SF001}/missing.parquet", f"{SF001}/nation.parquet", "/elsewhere/nation.parquet"]
    report = {r["source"]: r for r in run_migration(spark, ParquetSource(), refs, MigrationOptions(database=db)).collect()}
    assert report[refs[0]]["status"] == "success"
    assert report[refs[1]]["status"] == "failed" and report[refs[1]]["error"]
    # two sources would land in one target: both refused before any write
    assert report[refs[2]]["status"] == "failed" and "shared" in report[refs[2]]["error"]
    assert report[refs[3]]["status"] == "failed"
    assert not spark.catalog.tableExists(f"{db}.nation")


def test_bad_options_fail_before_any_work(spark, db):
    with pytest.raises(ValueError, match="unknown write mode"):
        run_migration(spark, ParquetSource(), [f"{SF001}/orders.parquet"], MigrationOptions(database=db, mode="upsert"))
    assert not spark.catalog.tableExists(f"{db}.orders")


def test_register_refuses_catalog_sources(spark, db):
    with pytest.raises(ValueError, match="Parquet paths"):
        migrate_table(spark, CatalogSource(database=db), "x", MigrationOptions(database=db, mode="register"))


def test_append_mode_counts_only_added_rows(spark, db):
    ref = f"{SF001}/region.parquet"
    opts = MigrationOptions(database=db)
    run_migration(spark, ParquetSource(), [ref], opts).collect()
    rep = run_migration(spark, ParquetSource(), [ref], MigrationOptions(database=db, mode="append")).first()
    assert (rep["source_rows"], rep["added_rows"], rep["target_rows"], rep["status"]) == (5, 5, 10, "success")


def test_catalog_source_copy_partitioned_and_summary(spark, db):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    orders.write.partitionBy("o_orderstatus").saveAsTable(f"{db}.src_orders")
    opts = MigrationOptions(database=db, partition_by=("o_orderstatus",), verify="content")
    report = run_migration(spark, CatalogSource(database=db), ["src_orders"], opts, targets={"src_orders": "dst_orders"})
    row = report.first()
    assert row["status"] == "success", row["error"]
    summary = {r["status"]: r["n_tables"] for r in summarize(report).collect()}
    assert summary == {"success": 1}


def test_subset_selection():
    assert select_tables(["a", "b", "c"], "a,,c ") == ["a", "c"]
    assert select_tables(["a", "", "b"], None) == ["a", "b"]
    assert select_tables(["a"], ["b"]) == ["b"]


def test_plan_targets_names(spark):
    planned = dict(plan_targets(ParquetSource(), ["/x/a.b.parquet", "/x/ok.parquet"], MigrationOptions(database="d")))
    assert isinstance(planned["/x/a.b.parquet"], ValueError)
    assert planned["/x/ok.parquet"] == "`spark_catalog`.`d`.`ok`"


def test_staging_load_and_export(spark, db, scratch):
    from carryover.plans import stage_exports, stage_tables

    inputs = {"orders": f"{SF001}/orders.parquet", "nope": f"{SF001}/nope.parquet"}
    rep = {r["name"]: r for r in stage_tables(spark, inputs, db, max_rows=100).collect()}
    assert rep["orders"]["n_rows"] == 100 and rep["orders"]["status"] == "success"
    assert rep["nope"]["status"] == "failed"
    root = scratch("stage")
    first = stage_exports(spark, {"orders": inputs["orders"]}, root, max_rows=50, order_by=["o_orderkey"])
    assert sorted((r["ds"], r["n_rows"]) for r in first.collect()) == [("2024-01-15", 50), ("2024-01-16", 50)]
    tree = spark.read.parquet(f"{root}/orders")
    # the same capped rows in both ds values (one scan of one capped input)
    a = tree.where("ds = '2024-01-15'").drop("ds")
    b = tree.where("ds = '2024-01-16'").drop("ds")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    again = stage_exports(spark, {"orders": inputs["orders"]}, root, max_rows=50, order_by=["o_orderkey"])
    assert {r["n_rows"] for r in again.collect()} == {50}  # re-run appends, and says so
    assert spark.read.parquet(f"{root}/orders").count() == 200


def test_missing_source_creates_nothing(spark):
    from carryover.plans import MigrationOptions, run_migration

    db = "never_created_ns"
    row = run_migration(spark, ParquetSource(), [f"{SF001}/absent.parquet"], MigrationOptions(database=db)).first()
    assert row["status"] == "failed"
    assert not spark.catalog.databaseExists(db)


def test_checks_in_parallel_keep_file_order_and_label_jobs(spark, db):
    from carryover.plans import parse_checks, run_checks
    from carryover.plans.checks import count_equal_sql, non_empty_sql

    df = spark.read.parquet(f"{SF001}/orders.parquet")
    df.write.saveAsTable(f"{db}.a")
    df.write.saveAsTable(f"{db}.b")
    text = "\n\n".join(
        [f"-- ASSERT: eq\n{count_equal_sql(f'{db}.a', f'{db}.b')}", f"-- ASSERT: ne\n{non_empty_sql(f'{db}.a')}",
         f"-- ASSERT: bad\nSELECT count(*) > 0 FROM {db}.zzz", f"SELECT count(*) AS n FROM {db}.a"] * 3
    )
    serial = run_checks(spark, parse_checks(text))
    parallel = run_checks(spark, parse_checks(text), parallelism=4)
    assert serial.report.collect() == parallel.report.collect()
    assert (parallel.passed, parallel.failed) == (9, 3)
    assert spark.sparkContext.getLocalProperty("spark.job.description") is None


def test_odd_column_names_survive_export_and_register(spark, db, scratch):
    from carryover.operators import fingerprint, register_files

    path = scratch("odd")
    df = spark.sql("SELECT id, CAST(id % 3 AS STRING) AS `part.key`, id * 2 AS `a b` FROM range(30)")
    ex = export_partitioned(df, path, ["part.key"], verify=True)
    assert sorted(r["n_rows"] for r in ex.partitions.collect()) == [10, 10, 10]
    reg = register_files(spark, path, f"{db}.odd")
    assert reg.status == "success" and reg.layout.partition_columns == ("part.key",)
    got = spark.table(f"{db}.odd")
    assert fingerprint(got, ["id", "a b"]) == fingerprint(df, ["id", "a b"])


def test_failed_assertion_reports_its_row(spark):
    from carryover.plans import parse_checks, run_checks

    run = run_checks(spark, parse_checks("-- ASSERT: zero\nSELECT 0 AS ok, 'why' AS note\n"))
    row = run.report.first()
    assert row["status"] == "failed" and "'note': 'why'" in row["detail"]
    assert run.exit_code == 1


def test_append_reports_the_whole_table_and_checks_content_where_it_touches(spark, db, scratch):
    from carryover.plans.batch import touched_rows

    events = spark.read.parquet(f"{SF001}/events.parquet").withColumn("ds", F.to_date("ts"))
    hist, day = scratch("hist"), scratch("day")
    events.where("ds < DATE '2024-01-20'").write.parquet(hist)
    events.where("ds = DATE '2024-01-25'").write.parquet(day)
    opts = MigrationOptions(database=db, partition_by=("ds",))
    first = run_migration(spark, ParquetSource(), [hist], opts, targets={hist: "ev"}).first()
    assert first["status"] == "success"
    n_day = events.where("ds = DATE '2024-01-25'").count()
    whole = first["source_rows"]
    for verify in ("content", "count"):
        options = MigrationOptions(database=db, mode="append", verify=verify)
        rep = run_migration(spark, ParquetSource(), [day], options, targets={day: "ev"}).first()
        whole += n_day
        assert (rep["status"], rep["source_rows"], rep["added_rows"], rep["target_rows"]) == ("success", n_day, n_day, whole)
    # what a content check reads of the target: the touched days, pruned by a semi-join
    touched = touched_rows(spark.read.parquet(day), spark.table(f"{db}.ev"), ["ds"])
    assert touched.count() == 2 * n_day
    assert "LeftSemi" in touched._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("verify", ["count", "content"])
def test_append_spanning_many_partitions(spark, db, scratch, verify):
    base, extra = scratch("base"), scratch("extra")
    spark.sql("SELECT id, CAST(id % 200 AS INT) AS p FROM range(400)").write.parquet(base)
    spark.sql("SELECT id, CAST(id % 300 AS INT) AS p FROM range(900)").write.parquet(extra)
    opts = MigrationOptions(database=db, partition_by=("p",))
    run_migration(spark, ParquetSource(), [base], opts, targets={base: "many"}).collect()
    options = MigrationOptions(database=db, mode="append", verify=verify)
    rep = run_migration(spark, ParquetSource(), [extra], options, targets={extra: "many"}).first()
    assert (rep["status"], rep["source_rows"], rep["added_rows"], rep["target_rows"]) == ("success", 900, 900, 1300)


@pytest.mark.parametrize("verify", ["count", "content"])
def test_append_of_another_type_and_letter_case(spark, db, scratch, verify):
    base, extra = scratch("base"), scratch("extra")
    spark.sql("SELECT id, IF(id = 0, 'abc', CAST(id % 2 AS STRING)) AS p FROM range(10)").write.parquet(base)
    spark.sql("SELECT id, CAST(id % 2 AS INT) AS P FROM range(3)").write.parquet(extra)
    opts = MigrationOptions(database=db, partition_by=("p",))
    run_migration(spark, ParquetSource(), [base], opts, targets={base: "kinds"}).collect()
    options = MigrationOptions(database=db, mode="append", verify=verify)
    rep = run_migration(spark, ParquetSource(), [extra], options, targets={extra: "kinds"}).first()
    assert (rep["status"], rep["added_rows"], rep["target_rows"]) == ("success", 3, 13), rep["error"]


@pytest.mark.parametrize("verify", ["count", "content"])
def test_append_of_a_null_partition_value(spark, db, scratch, verify):
    base, extra = scratch("base"), scratch("extra")
    spark.sql("SELECT id, CAST(id % 2 AS STRING) AS p FROM range(10)").write.parquet(base)
    spark.sql("SELECT id, CAST(NULL AS STRING) AS p FROM range(3)").write.parquet(extra)
    run_migration(spark, ParquetSource(), [base], MigrationOptions(database=db, partition_by=("p",)), targets={base: "nul"}).collect()
    options = MigrationOptions(database=db, mode="append", verify=verify)
    rep = run_migration(spark, ParquetSource(), [extra], options, targets={extra: "nul"}).first()
    assert (rep["status"], rep["added_rows"], rep["target_rows"]) == ("success", 3, 13)


def test_errors_are_reported_whole(spark, db):
    rep = run_migration(spark, ParquetSource(), [f"{SF001}/nope.parquet"], MigrationOptions(database=db)).first()
    assert rep["status"] == "failed" and "nope.parquet" in rep["error"]
    from carryover.plans.batch import _failed

    assert _failed("a", None, "create", ValueError("first line\n" + "x" * 5000))["error"].endswith("x" * 5000)


def test_information_queries_run_to_their_end(spark):
    from carryover.plans import parse_checks, run_checks

    run = run_checks(spark, parse_checks("SELECT id, 1 DIV (id - 99999) AS q FROM range(100000)\n\nSELECT id FROM range(50)\n"))
    assert [r["status"] for r in run.report.orderBy("position").collect()] == ["error", "passed"]
    assert len(run.samples["Query #2"]) == 20


def test_exports_of_named_values_are_not_shuffled(spark, scratch):
    from carryover.operators import prepare_for_write

    def shuffled(df, **kw):
        return "Exchange" in prepare_for_write(df, partition_by=["ds"], **kw)._jdf.queryExecution().executedPlan().toString()

    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    assert not shuffled(tag_partition(orders, "ds", "2024-01-15"))
    assert not shuffled(replicate_partitions(orders, "ds", ["2024-01-15", "2024-01-16"]))
    by_status = orders.withColumnRenamed("o_orderstatus", "ds")
    assert shuffled(by_status) and not shuffled(by_status, cluster="none")


def test_stage_exports_notes_an_input_that_changes(spark, scratch):
    from carryover.plans import stage_exports

    changing = spark.range(10).where("rand() < 2").selectExpr("id")
    calls = []

    def read(path):
        calls.append(path)
        return changing.where("rand() < 0.5") if path == "moving" else changing

    rows = stage_exports(spark, {"still": "still"}, scratch("st"), read=read).collect()
    assert [(r["n_rows"], r["error"]) for r in rows] == [(10, None), (10, None)]
    from unittest import mock

    from carryover.operators.write import Exported
    from carryover.plans import staging

    def other_total(df, path, cols):
        return Exported(path=path, rows=99, partitions=df.groupBy(*cols).count().withColumnRenamed("count", "n_rows"))

    with mock.patch.object(staging, "export_partitioned", other_total):
        rows = stage_exports(spark, {"x": "still"}, scratch("st"), read=read).collect()
    assert all(r["error"].startswith("mismatch: wrote 99") for r in rows)


def test_ref_listed_twice_runs_once(spark, db):
    ref = f"{SF001}/region.parquet"
    rows = run_migration(spark, ParquetSource(), [ref, ref], MigrationOptions(database=db), parallelism=2).collect()
    assert [r["status"] for r in rows] == ["success", "failed"]
    assert "more than once" in rows[1]["error"]
    assert spark.table(f"{db}.region").count() == 5


def test_append_with_empty_string_partition_value(spark, db, scratch):
    base, extra = scratch("base"), scratch("extra")
    spark.sql("SELECT id, CAST(id % 2 AS STRING) AS p FROM range(10)").write.parquet(base)
    spark.sql("SELECT id, '' AS p FROM range(4)").write.parquet(extra)
    opts = MigrationOptions(database=db, partition_by=("p",))
    run_migration(spark, ParquetSource(), [base], opts, targets={base: "es"}).collect()
    rep = run_migration(spark, ParquetSource(), [extra], MigrationOptions(database=db, mode="append"), targets={extra: "es"}).first()
    assert (rep["status"], rep["added_rows"]) == ("success", 4), rep


def test_export_overwrite_replaces_only_its_partitions(spark, scratch):
    path = scratch("ow")
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    export_partitioned(replicate_partitions(orders, "ds", ["2024-01-15", "2024-01-16"]), path, ["ds"])
    again = export_partitioned(tag_partition(orders, "ds", "2024-01-16"), path, ["ds"], mode="overwrite")
    assert {str(r["ds"]): r["n_rows"] for r in again.partitions.collect()} == {"2024-01-16": orders.count()}
    tree = spark.read.parquet(path)
    assert tree.count() == 2 * orders.count()  # not tripled, and 2024-01-15 still there
    assert tree.where("ds = '2024-01-15'").count() == orders.count()


def test_content_check_with_empty_string_partition_values(spark, db, scratch):
    src = scratch("blank")
    spark.sql("SELECT id, CASE WHEN id % 3 = 0 THEN '' ELSE CAST(id % 2 AS STRING) END AS p FROM range(12)").write.parquet(src)
    opts = MigrationOptions(database=db, partition_by=("p",), verify="content")
    rep = run_migration(spark, ParquetSource(), [src], opts, targets={src: "blank"}).first()
    assert rep["status"] == "success", rep
    again = run_migration(
        spark, ParquetSource(), [src], MigrationOptions(database=db, mode="append", verify="content"), targets={src: "blank"}
    ).first()
    assert (again["status"], again["added_rows"]) == ("success", 12), again


def test_unverified_registration_says_so(spark, db, scratch):
    from carryover.operators import register_files

    path = scratch("uv")
    spark.read.parquet(f"{SF001}/region.parquet").write.parquet(path)
    assert register_files(spark, path, f"{db}.uv", count=False).status == "unverified"


def test_relative_paths_are_qualified_like_readers_do(spark):
    from carryover.sources import qualified_path

    here = qualified_path(spark, ".")
    assert qualified_path(spark, "rel/tree") == here.rstrip("/") + "/rel/tree"
    assert qualified_path(spark, "/abs/x").endswith(":/abs/x")


def test_register_batch_with_content_verification(spark, db, scratch):
    path = scratch("regc")
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    export_partitioned(orders, path, ["o_orderstatus"])
    rep = run_migration(
        spark, ParquetSource(), [path], MigrationOptions(database=db, mode="register", verify="content"),
        targets={path: "regc"},
    ).first()
    assert (rep["status"], rep["source_rows"], rep["target_rows"]) == ("success", orders.count(), orders.count()), rep


def test_info_sql_with_and_without_partition_columns(spark, db):
    from carryover.plans.checks import info_sql

    spark.read.parquet(f"{SF001}/region.parquet").write.saveAsTable(f"{db}.ra")
    rows = spark.sql(info_sql([("a", f"{db}.ra", "r_name"), ("b", f"{db}.ra", None)])).collect()
    assert [(r["tbl"], r["n_rows"], r["partitions"]) for r in rows] == [("a", 5, 5), ("b", 5, None)]


def test_partition_stats_with_dotted_column(spark, scratch):
    path = scratch("dot")
    spark.sql("SELECT id AS `a.b`, CAST(id % 2 AS STRING) AS p FROM range(10)").write.partitionBy("p").parquet(path)
    got = {r["p"]: (r["n_rows"], r["min_a.b"]) for r in partition_stats(spark.read.parquet(path), ["a.b"], ["p"]).collect()}
    assert got == {0: (5, 0), 1: (5, 1)}  # p=0 / p=1 folders are read back as integers


def test_stage_exports_isolates_a_bad_input(spark, scratch):
    from carryover.plans import stage_exports

    root = scratch("iso")
    rows = stage_exports(
        spark, {"bad": f"{SF001}/nope.parquet", "region": f"{SF001}/region.parquet"}, root, max_rows=0
    ).collect()
    by = {(r["name"], r["ds"]): r for r in rows}
    assert by[("bad", None)]["error"] and by[("region", "2024-01-15")]["n_rows"] == 5


def test_stage_tables_into_a_catalog_qualified_database(spark, db):
    from carryover.plans import stage_tables

    rows = stage_tables(spark, {"reg": f"{SF001}/region.parquet"}, f"spark_catalog.{db}", max_rows=0).collect()
    assert rows[0]["status"] == "success", rows[0]["error"]
    assert spark.table(f"{db}.reg").count() == 5
