"""Statistics per partition that merge."""

import pytest
from pyspark.sql import functions as F

from carryover.operators import (
    compact_statistics,
    estimates,
    merge_sketches,
    partition_sketches,
    read_statistics,
    record_statistics,
)
from conftest import SF01


def _plain(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


def test_merged_loads_are_one_scan(spark):
    items = spark.read.parquet(f"{SF01}/lineitem.parquet")
    columns, part = ["l_orderkey", "l_shipdate"], "l_returnflag"
    whole = partition_sketches(items, columns, [part], ["l_orderkey"])
    halves = [items.where(F.col("l_orderkey") % 3 == i) for i in range(3)]
    rows = [partition_sketches(h, columns, [part], ["l_orderkey"]) for h in halves]
    merged = merge_sketches(rows[0].unionByName(rows[1]).unionByName(rows[2]), [part])
    exact = [c for c in whole.columns if not c.startswith(("distinct_", "quantiles_"))]
    assert _plain(merged.select(exact)) == _plain(whole.select(exact))
    for r in estimates(merged).join(items.groupBy(part).agg(F.count_distinct("l_orderkey").alias("n")), part).collect():
        assert abs(r["distinct_l_orderkey"] - r["n"]) <= 0.05 * r["n"]


def test_coarser_questions_from_finer_rows(spark, db):
    df = spark.range(6000).selectExpr("id % 12 AS month", "id % 3 AS kind", "id % 1000 AS v")
    record_statistics(df, f"{db}.st", ["v"], ["month", "kind"], quantiles=["v"])
    by_kind = {r["kind"]: r for r in read_statistics(spark, f"{db}.st", ["month", "kind"], by=["kind"]).collect()}
    assert {k: r["n_rows"] for k, r in by_kind.items()} == {0: 2000, 1: 2000, 2: 2000}
    (whole,) = read_statistics(spark, f"{db}.st", ["month", "kind"], by=[], ranks=(0.0, 0.5, 1.0)).collect()
    assert (whole["n_rows"], whole["min_v"], whole["max_v"], whole["nulls_v"]) == (6000, 0, 999, 0)
    assert abs(whole["distinct_v"] - 1000) <= 50
    low, middle, high = whole["quantiles_v"]
    assert low == 0 and high == 999 and abs(middle - 499.5) <= 30


def test_a_load_reads_only_what_it_brings_and_resets_hide_older_rows(spark, db):
    table = f"{db}.st"
    record_statistics(spark.range(10).selectExpr("id", "'a' AS p"), table, ["id"], ["p"])
    record_statistics(spark.range(10, 30).selectExpr("id", "IF(id < 20, 'a', 'b') AS p"), table, ["id"], ["p"])
    assert spark.table(table).count() == 3  # one row a load and partition
    rows = lambda: {r["p"]: (r["n_rows"], r["min_id"], r["max_id"], r["distinct_id"]) for r in read_statistics(spark, table, ["p"]).collect()}
    assert rows() == {"a": (20, 0, 19, 20), "b": (10, 20, 29, 10)}
    record_statistics(spark.range(100, 105).selectExpr("id", "'a' AS p"), table, ["id"], ["p"], resets=True)
    assert rows() == {"a": (5, 100, 104, 5), "b": (10, 20, 29, 10)}
    record_statistics(spark.range(1).selectExpr("id", "'a' AS p"), table, ["id"], ["p"])
    want = rows()
    assert want["a"] == (6, 0, 104, 6)
    compact_statistics(spark, table, ["p"])
    assert spark.table(table).count() == 2 and rows() == want
    record_statistics(spark.range(200, 201).selectExpr("id", "'b' AS p"), table, ["id"], ["p"], resets=True)
    assert rows()["b"] == (1, 200, 200, 1)


def test_every_type_nulls_and_empty_input(spark, db):
    df = spark.sql(
        "SELECT * FROM VALUES (CAST(1 AS TINYINT), 0.0D, DATE'2024-01-01', true, 1.50BD, X'01', CAST(NULL AS INT), 'k', CAST(NULL AS STRING)),"
        " (1Y, -0.0D, DATE'2024-01-02', true, 1.5BD, X'02', NULL, 'k', NULL) AS t(a, b, c, d, e, f, g, `h.i`, p)"
    )
    columns = [c for c in df.columns if c != "p"]
    (row,) = estimates(partition_sketches(df, columns, ["p"], ["a", "g"])).collect()
    assert [row[f"distinct_{c}"] for c in columns] == [1, 1, 2, 1, 1, 2, 0, 1]
    assert row["nulls_g"] == 2 and row["quantiles_g"] is None and row["quantiles_a"] == [1.0] and row["p"] is None
    assert partition_sketches(df.where("false"), columns, ["p"]).count() == 0
    record_statistics(df.where("false"), f"{db}.none", ["a"], ["p"])
    assert read_statistics(spark, f"{db}.none", ["p"]).count() == 0
    with pytest.raises(ValueError, match="number columns"):
        partition_sketches(df, ["h.i"], ["p"], ["h.i"])


def test_partial_aggregation_comes_before_the_shuffle(spark):
    plan = partition_sketches(spark.range(10).selectExpr("id", "id % 2 AS p"), ["id"], ["p"], ["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_hll_sketch_agg") > text.index("Exchange") and text.count("Exchange") == 1
