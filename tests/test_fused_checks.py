"""Fused assertions: the same report from one scan a table; information queries run once."""

import pytest

from carryover.operators import write_table
from carryover.plans import parse_checks, run_checks
from carryover.plans.fuse import analyse, fuse
from conftest import SF001


@pytest.fixture()
def tables(spark, db):
    for name, part in (("orders", ["o_orderstatus"]), ("lineitem", [])):
        write_table(spark.read.parquet(f"{SF001}/{name}.parquet"), f"{db}.{name}", "create", partition_by=part)
    return db


TEXT = """
-- ASSERT: not empty
SELECT count(*) > 0 AS ok FROM {db}.orders

-- ASSERT: has statuses
SELECT count(DISTINCT o_orderstatus) > 0 FROM {db}.orders

-- ASSERT: one status has rows
SELECT count(*) > 0 AS ok FROM {db}.ORDERS WHERE o_orderstatus = 'F' -- the filled ones

-- ASSERT: no such status
SELECT count(*) > 0 AS ok FROM {db}.orders WHERE o_orderstatus = 'nope' OR o_orderkey < 0;

-- ASSERT: counts equal
SELECT (SELECT count(*) FROM {db}.orders) = (SELECT count(*) FROM {db}.orders WHERE o_orderkey IS NOT NULL) AS ok

-- ASSERT: fewer orders than items
SELECT (SELECT count(*) FROM {db}.orders) < (SELECT count(*) FROM {db}.lineitem) AS ok

-- ASSERT: sums and their filter
SELECT coalesce(sum(l_quantity), 0) > 10 AND bool_and(l_discount >= 0) FROM {db}.lineitem

-- ASSERT: own filter
SELECT count(*) FILTER (WHERE l_tax > 0 AND l_returnflag LIKE '_' AND l_linenumber IN (1, 2)) BETWEEN 1 AND 100000000 FROM {db}.lineitem

-- ASSERT: text is no answer
SELECT max(l_returnflag) FROM {db}.lineitem

-- ASSERT: null is no answer
SELECT sum(l_quantity) > 0 AS ok FROM {db}.lineitem WHERE l_orderkey < 0

-- ASSERT: fails at run time
SELECT sum(CAST(l_returnflag AS INT)) > 0 FROM {db}.lineitem

-- ASSERT: no such column
SELECT sum(nope) > 0 FROM {db}.orders

-- ASSERT: no such table
SELECT count(*) > 0 FROM {db}.nope

-- ASSERT: grouped, several rows
SELECT count(*) > 0 FROM {db}.orders GROUP BY o_orderstatus

-- ASSERT: two columns
SELECT count(*) > 0, 1 FROM {db}.orders

SELECT count(*) AS n FROM {db}.orders
"""


def _report(run):
    return [tuple(r)[:4] + ((r["detail"] or "").split("\n")[0][:120],) for r in run.report.collect()]


def test_the_report_is_the_same(spark, tables):
    checks = parse_checks(TEXT.format(db=tables))
    alone, fused = run_checks(spark, checks), run_checks(spark, checks, fuse=True, parallelism=3)
    assert _report(fused) == _report(alone) and (fused.passed, fused.failed) == (alone.passed, alone.failed)
    assert [r["status"] for r in alone.report.collect()].count("passed") == 10


def test_one_scan_a_table(spark, tables):
    checks = parse_checks(TEXT.format(db=tables))
    both = fuse(spark, [c.sql if c.is_assertion else None for c in checks])
    assert {k[-1] for k in both.queries} == {"orders", "lineitem"}
    assert sorted(both.plain) == list(range(11))  # the first eleven
    for query in both.queries.values():
        plan = query._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1, plan
    asked = both.queries[next(k for k in both.queries if k[-1] == "orders")].columns
    assert len(asked) == 5  # count(*) stands in three statements


def test_jobs_fall_with_the_statements(spark, tables):
    checks = parse_checks(TEXT.format(db=tables))[:9]
    tracker = spark.sparkContext.statusTracker()

    def jobs(tag, **how):
        spark.sparkContext.setJobGroup(tag, tag)
        run_checks(spark, checks, **how)
        return len(tracker.getJobIdsForGroup(tag))

    assert jobs("fused checks", fuse=True) < jobs("checks alone") / 2


def test_filters_prune_when_every_call_has_one(spark, tables):
    one = [f"SELECT count(*) > 0 FROM {tables}.orders WHERE o_orderstatus = '{s}'" for s in "FO"]
    plan = fuse(spark, one).queries.popitem()[1]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((o_orderstatus" in plan


@pytest.mark.parametrize("sql", [
    "SELECT 1", "SELECT a FROM t", "SELECT count(*) FROM t a", "SELECT count(*) OVER () FROM t", "SELECT DISTINCT count(*) FROM t", "SELECT count(*) FROM t LIMIT 1",
    "SELECT count(*) FROM t, u", "SELECT my_agg(x) FROM t", "SELECT count(*) > (SELECT 1) FROM t", "SELECT count(*) FROM t WHERE x IN (SELECT y FROM u)",
    "SELECT (SELECT max(x) FROM t GROUP BY y)", "SELECT count(*) FROM t HAVING count(*) > 1", "SELECT count(*) FROM t UNION ALL SELECT 1", "WITH a AS (SELECT 1) SELECT count(*) FROM a",
    "SELECT count(*) FILTER (WHERE a) FROM t WHERE b", "SELECT count(*) + x FROM t", "not sql", "SELECT rand() < 1",
])
def test_other_shapes_run_alone(spark, sql):
    assert analyse(spark, sql) is None


def test_information_queries_run_once(spark, tables):
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    spark.udf.register("counted_once", count, "long")
    run = run_checks(spark, parse_checks("SELECT counted_once(id) AS a, id AS a, NULL AS nothing FROM range(10)"), sample_rows=3)
    assert run.passed == 1 and len(run.samples["Query #1"]) == 3 and seen.value == 10
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
