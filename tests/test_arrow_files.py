"""Arrow IPC files through the Python Data Source API."""

import os

import pytest

from carryover.plans import MigrationOptions, run_migration
from carryover.sources import ArrowSource, get_source, register_arrow_files
from conftest import SF001


@pytest.fixture()
def tree(spark, scratch):
    register_arrow_files(spark)
    path = scratch("arrow")
    spark.read.parquet(f"{SF001}/orders.parquet").repartition(3).write.format("arrow_files").mode("append").save(path)
    return path


def test_round_trip_and_splits(spark, tree):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    df = ArrowSource(split_bytes=10_000).read(spark, tree)
    assert df.dtypes == orders.dtypes and df.rdd.getNumPartitions() > 3
    assert df.exceptAll(orders).count() == 0 and df.count() == orders.count()
    assert not [f for f in os.listdir(tree) if f.startswith("_")]  # the hidden folder is gone


def test_columns_and_filters(spark, tree):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    few = ArrowSource(columns=("o_custkey", "o_orderkey")).read(spark, tree)
    assert few.columns == ["o_custkey", "o_orderkey"]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        for where in (
            "o_orderkey > 100 AND o_orderkey <= 900",
            "o_orderstatus IN ('F', 'P') AND o_custkey IS NOT NULL",
            "NOT (o_orderstatus = 'F')",
            "o_totalprice > 1000.5 AND o_orderkey = 7",
            "o_orderdate > TIMESTAMP_NTZ'1995-01-01 00:00:00'",
            "o_orderpriority IS NULL",
        ):
            got = ArrowSource().read(spark, tree).where(where)
            assert got.count() == orders.where(where).count(), where
            assert got.exceptAll(orders.where(where)).count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_nulls_nested_values_and_empty_files(spark, scratch):
    register_arrow_files(spark)
    path = scratch("arrow")
    df = spark.sql(
        "SELECT IF(id = 1, NULL, id) AS a, named_struct('x', id, 'y', array('p', NULL)) AS s, map('k', id) AS m,"
        " CAST(id AS DECIMAL(10,2)) AS d, DATE'2024-01-01' AS t, CAST('b' AS BINARY) AS b, 'ü' AS `a.b` FROM range(3)"
    )
    df.repartition(6).write.format("arrow_files").mode("append").save(path)
    back = get_source("arrow").read(spark, path)
    assert back.dtypes == df.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    empty = scratch("arrow")
    df.where("false").write.format("arrow_files").mode("append").save(empty)
    with_rows = [f for f in os.listdir(empty)]
    assert (get_source("arrow").read(spark, empty).count() if with_rows else 0) == 0
    with pytest.raises(Exception, match="no such path"):
        get_source("arrow").read(spark, scratch("nothing"))


def test_overwrite_replaces_and_a_failed_write_leaves_no_rows(spark, tree):
    n = spark.read.parquet(f"{SF001}/orders.parquet").count()
    bad = spark.sql("SELECT raise_error('no') AS x FROM range(2)")
    with pytest.raises(Exception):
        bad.write.format("arrow_files").mode("append").save(tree)
    assert ArrowSource().read(spark, tree).count() == n
    spark.range(4).write.format("arrow_files").mode("overwrite").save(tree)
    assert sorted(r["id"] for r in ArrowSource().read(spark, tree).collect()) == [0, 1, 2, 3]


def test_files_of_other_columns_are_named(spark, tree):
    spark.range(4).write.format("arrow_files").mode("append").save(f"{tree}/zz")
    with pytest.raises(Exception, match="lacks"):
        ArrowSource().read(spark, tree).collect()


def test_migrating_arrow_files(spark, db, tree):
    source = get_source("arrow", columns=["o_orderkey", "o_orderstatus"])
    opts = MigrationOptions(database=db, verify="content", partition_by=("o_orderstatus",))
    rep = run_migration(spark, source, [tree], opts, targets={tree: "orders"}).first()
    assert (rep["status"], rep["target_rows"]) == ("success", spark.read.parquet(f"{SF001}/orders.parquet").count()), rep
    assert source.target_name("/a/b/orders.arrow") == "orders"
