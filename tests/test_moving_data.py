"""Appends that count once, parallel caps, and differences found by descending fingerprints."""

import pytest
from pyspark.sql import functions as F

from carryover.keys import limit_rows_parallel
from carryover.operators import append_once, difference, limit_rows, once, rows_not_in, write_table
from conftest import SF001


def _orders(spark):
    return spark.read.parquet(f"{SF001}/orders.parquet")


def _target(spark, db, parts):
    write_table(_orders(spark).limit(0), f"{db}.orders", "create", partition_by=parts)
    return f"{db}.orders"


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("parts", [[], ["o_orderstatus"]])
def test_a_finished_load_adds_nothing_again(spark, db, parts):
    table, df = _target(spark, db, parts), _orders(spark)
    assert append_once(df, table, "day 1").status == "added"
    again = append_once(df.repartition(3), table, "day 1")
    assert (again.status, again.rows) == ("already", df.count()) and _same(df, spark.table(table))
    assert append_once(df, table, "day 2").status == "added" and spark.table(table).count() == 2 * df.count()
    with pytest.raises(ValueError, match="other rows"):
        append_once(df.limit(5), table, "day 2")
    assert append_once(df.limit(5), table, "day 2", verify_source=False).status == "already"
    write_table(df, table, "append")  # other writers are not disturbed
    assert spark.table(table).count() == 3 * df.count()


@pytest.mark.parametrize("parts", [[], ["o_orderstatus"]])
@pytest.mark.parametrize("died", ["before writing", "while writing", "after writing", "while moving", "before done"])
def test_a_load_that_died_is_redone_or_finished(spark, db, parts, died, monkeypatch):
    table, df = _target(spark, db, parts), _orders(spark).repartition(4)
    df = df.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 5 == 0, None).otherwise(F.col("o_orderpriority")))
    append_once(df.limit(3).cache(), table, "earlier")
    with monkeypatch.context() as m:
        if died == "before writing":
            m.setattr(once, "prepare_for_write", lambda *a, **k: 1 / 0)
        elif died == "while writing":
            real = once._observed
            m.setattr(once, "_observed", lambda d, fp: real(d.withColumn("o_custkey", F.expr("if(o_orderkey % 50 = 7, assert_true(false), o_custkey)").cast("long")), fp))
        elif died == "after writing":
            m.setattr(once, "publish", lambda *a: 1 / 0)
        elif died == "while moving":
            moved = []

            def some(spark_, folder, to):
                fs, hadoop = once._fs(spark_, folder)
                files = [s for s in fs.listStatus(hadoop) if s.getPath().getName().endswith(".parquet")]
                target = spark_._jvm.org.apache.hadoop.fs.Path(to)
                fs.mkdirs(target)
                fs.rename(files[0].getPath(), spark_._jvm.org.apache.hadoop.fs.Path(target, files[0].getPath().getName()))
                moved.append(to)
                raise RuntimeError("died")

            m.setattr(once, "_move_files", some)
        else:
            real_note = once._note
            m.setattr(once, "_note", lambda s, t, i, state, *a: 1 / 0 if state == "done" else real_note(s, t, i, state, *a))
        with pytest.raises(Exception):
            append_once(df, table, "load")
    if died in ("before writing", "while writing", "after writing"):
        assert spark.table(table).count() == 3  # nothing of the load is seen
    done = append_once(df, table, "load")
    assert done.status == "recovered" and done.rows == df.count()
    assert spark.table(table).count() == df.count() + 3 and append_once(df, table, "load").status == "already"
    assert df.exceptAll(spark.table(table).select(*df.columns)).isEmpty()


def test_loads_must_fit_their_table(spark, db):
    table, df = _target(spark, db, []), _orders(spark)
    for bad in (df.drop("o_custkey"), df.withColumn("x", F.lit(1)), df.withColumn("o_custkey", F.col("o_custkey").cast("double"))):
        with pytest.raises(ValueError):
            append_once(bad, table, "bad")
    with pytest.raises(ValueError, match="does not exist"):
        append_once(df, f"{db}.nope", "x")
    assert append_once(df.withColumn("o_custkey", F.col("o_custkey").cast("int")), table, "narrow").rows == df.count()


def test_a_load_into_a_table_of_another_version(spark, db):
    """Partitions that a pointer replace moved take new files where they are now."""
    table, df = _target(spark, db, ["o_orderstatus"]), _orders(spark)
    write_table(df.where("o_orderstatus <> 'P'"), table, "replace", partition_by=["o_orderstatus"], staged="pointer")
    append_once(df, table, "more")
    assert spark.table(table).count() == df.count() + df.where("o_orderstatus <> 'P'").count()


# --- parallel cap


def test_a_parallel_cap_keeps_exactly_n_rows_in_several_tasks(spark, scratch):
    path = scratch("files")
    df = _orders(spark)
    df.repartition(7).write.parquet(path)
    files, total = spark.read.parquet(path), df.count()
    for n in (1, total // 7, total // 2, total - 1, total, total + 5):
        capped = limit_rows(files, n, parallel=True)
        rows = capped.collect()
        assert len(rows) == min(n, total) and "Limit" not in capped._jdf.queryExecution().executedPlan().toString()
        assert rows == limit_rows(files, n, parallel=True).collect()
        assert capped.exceptAll(files).isEmpty()
    half = limit_rows(files, total // 2, parallel=True)
    assert half.select(F.spark_partition_id()).distinct().count() > 1
    out = scratch("capped")
    half.write.parquet(out)
    assert spark.read.parquet(out).count() == total // 2


def test_a_parallel_cap_over_many_files_joins_their_quotas(spark, scratch, monkeypatch):
    from carryover.operators import transforms

    path = scratch("many")
    df = _orders(spark)
    df.repartition(9).write.partitionBy("o_orderstatus").parquet(path)
    monkeypatch.setattr(transforms, "MOST_FILES", 2)
    capped = limit_rows(spark.read.parquet(path), 500, parallel=True)
    assert capped.count() == 500 and capped.columns == spark.read.parquet(path).columns
    assert capped.select(*df.columns).exceptAll(df).isEmpty()


def test_other_inputs_get_the_plain_limit(spark, scratch):
    df = _orders(spark)
    for other in (df.where("o_orderkey > 3"), df.repartition(3), spark.range(50).toDF("id"), df.withColumn("x", F.rand())):
        capped = limit_rows(other, 20, parallel=True)
        assert capped.count() == 20 and "Limit" in capped._jdf.queryExecution().executedPlan().toString()
    assert limit_rows(df.select("o_custkey", "o_orderkey"), 20, parallel=True).count() == 20


def _shuffled(node):
    """Rows that the exchanges of an executed plan have written."""
    kind = node.nodeName()
    own = node.metrics().apply("shuffleRecordsWritten").value() if kind == "Exchange" else 0
    kids = node.children()
    below = [kids.apply(i) for i in range(kids.size())]
    if kind == "AdaptiveSparkPlan":
        below = [node.executedPlan()]
    elif kind.endswith("QueryStage"):
        below = [node.plan()]
    return own + sum(map(_shuffled, below))


def test_the_check_of_a_parallel_cap_shuffles_the_capped_rows_only(spark, scratch):
    root = scratch("items")
    spark.range(60_000).selectExpr("if(id % 7 = 0, null, id) AS l_orderkey", "id / 7 AS l_tax").write.parquet(f"{root}/lineitem.parquet")
    counted = limit_rows_parallel(spark, root)
    assert [tuple(r) for r in counted.collect()] == [(10_000, 0)]
    assert 0 < _shuffled(counted._jdf.queryExecution().executedPlan()) < 25_000


def test_rows_not_in_equals_except_all(spark):
    nan = float("nan")
    schema = "`a b` long, x double, t string"
    few = [(1, 0.5, "p")] * 3 + [(1, None, None)] * 2 + [(None, None, None), (2, nan, "q"), (3, -0.0, "r"), (4, 1.0, "s"), (4, 1.0, "s")]
    many = [(1, 0.5, "p")] * 2 + [(1, None, None)] * 5 + [(2, nan, "q"), (3, 0.0, "r"), (4, 1.0, "t"), (None, 1.0, None)] + [(9, 9.0, "z")] * 50
    few, many = (spark.createDataFrame(rows, schema) for rows in (few, many))
    wanted = few.exceptAll(many)
    for other in (many, many.select("t", "x", "a b")):
        found = rows_not_in(few, other)
        assert found.count() == wanted.count() == 4 and _same(found, wanted)
    assert _same(rows_not_in(few, many.limit(0)), few) and rows_not_in(few.limit(0), many).isEmpty()


# --- difference


def _changed(df):
    return (
        df.where("o_orderkey % 50 <> 3")
        .withColumn("o_totalprice", F.when(F.col("o_orderkey") % 60 == 5, F.lit(None)).otherwise(F.col("o_totalprice")))
        .unionByName(df.where("o_orderkey % 70 = 9"))
    )


@pytest.mark.parametrize("by", [[], ["o_orderstatus"], ["o_orderstatus", "o_orderpriority"]])
@pytest.mark.parametrize("buckets", [1, 4096])
def test_difference_equals_except_all(spark, by, buckets, monkeypatch):
    from carryover.operators import difference as module

    monkeypatch.setattr("carryover.operators.difference.BUCKETS", buckets) if hasattr(module, "BUCKETS") else None
    a = _orders(spark).withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 4 == 0, None).otherwise(F.col("o_orderstatus")))
    b = _changed(a).select(*reversed(a.columns))
    found = difference(a, b, by).cache()
    for side, x, y in (("left", a, b.select(*a.columns)), ("right", b.select(*a.columns), a)):
        own, wanted = found.where(F.col("side") == side).drop("side"), x.exceptAll(y)
        assert not wanted.isEmpty() and own.exceptAll(wanted).isEmpty() and wanted.exceptAll(own).isEmpty()


def test_equal_tables_have_no_difference(spark):
    a = _orders(spark)
    assert difference(a, a.repartition(5)).isEmpty() and difference(a.limit(0), a.limit(0)).isEmpty()
    assert difference(a.limit(0), a).count() == a.count()
    with pytest.raises(ValueError, match="columns differ"):
        difference(a, a.drop("o_custkey"))


def test_only_unequal_partitions_are_read_again(spark, db):
    a = _orders(spark)
    write_table(a, f"{db}.a", "create", partition_by=["o_orderstatus"])
    write_table(a.where("o_orderstatus <> 'F' OR o_orderkey % 9 <> 0"), f"{db}.b", "create", partition_by=["o_orderstatus"])
    left, right = spark.table(f"{db}.a"), spark.table(f"{db}.b")
    found = difference(left, right, ["o_orderstatus"])
    assert found.count() == a.where("o_orderstatus = 'F' AND o_orderkey % 9 = 0").count() > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(o_orderstatus" in plan or "<=> F" in plan
