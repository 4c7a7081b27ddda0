"""Print the physical plans of the main operations (used to write docs/PLANS.md).

    python tools/show_plans.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from carryover.operators import difference, export_partitioned, fingerprint_exprs, file_stats, limit_rows, prepare_for_write, register_files  # noqa: E402
from carryover.operators.validate import _slice_sums  # noqa: E402
from carryover.operators.write import _observed  # noqa: E402
from carryover.plans.checks import count_equal_sql  # noqa: E402
from carryover.plans.fuse import fuse  # noqa: E402
from carryover.session import local_session, scratch_database, scratch_path  # noqa: E402


def _pair_frame(a, b):
    cols = sorted(a.columns)
    h = lambda df, side: df.select(F.xxhash64(*cols).alias("_h"), F.lit(side).alias("_side"))
    return h(a, 0).unionByName(h(b, 1)).groupBy("_side").agg(F.count(F.lit(1)), *_slice_sums(F.col("_h")))


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().strip()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(4)
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    ev = spark.read.parquet(f"{sf}/events.parquet").withColumn("ds", F.date_format("ts", "yyyy-MM-dd"))
    path = scratch_path(spark, "plans")
    exported = export_partitioned(ev, path, ["ds"])
    db, _ = scratch_database(spark, "plans")
    register_files(spark, path, f"{db}.events")
    li.write.saveAsTable(f"{db}.lineitem")
    ev.write.partitionBy("ds").saveAsTable(f"{db}.events_by_day")
    from carryover.plans.batch import touched_rows

    capped = scratch_path(spark, "capped")
    li.repartition(8).write.parquet(capped)
    one_day = ev.where("ds = '2024-01-15'")
    touched = touched_rows(one_day, spark.table(f"{db}.events_by_day"), ["ds"])
    sections = [
        ("Copy: the DataFrame handed to the writer (count observed in the same stage)", _observed(li, False)[0]),
        ("Partitioned copy: rebalanced on the partition column, count observed after the exchange",
         _observed(prepare_for_write(li, partition_by=["l_returnflag"]), False)[0]),
        ("Compaction (repartition='auto'): one rebalance exchange, AQE sizes the output",
         prepare_for_write(li, repartition="auto")),
        ("Target count after a copy (no column read)", spark.table(f"{db}.lineitem").groupBy().count()),
        ("Content fingerprint (partial aggregate per task, one row per task shuffled)",
         spark.table(f"{db}.lineitem").agg(*fingerprint_exprs(li))),
        ("Two-sided content comparison: both scans in one map stage (Union under one Exchange)",
         _pair_frame(li, spark.table(f"{db}.lineitem"))),
        ("Register validation: files and table counted in one job, no column read",
         spark.read.parquet(path).select(F.lit(0).alias("_side"))
         .unionByName(spark.table(f"{db}.events").select(F.lit(1).alias("_side")))
         .groupBy("_side").count()),
        ("Registered table, one partition counted (directory pruning)",
         spark.table(f"{db}.events").where("ds = '2024-01-15'").groupBy().count()),
        ("Registered table, data filter pushed into the Parquet reader",
         spark.table(f"{db}.events").where("user_id = 42").select("event_id")),
        ("Rows per exported partition (only ts is read)", exported.partitions),
        ("Content check of an append: the touched partitions by a left-semi join (pruned at run time)",
         touched.groupBy().count()),
        ("File statistics (two columns read, pre-aggregated per file)",
         file_stats(spark.table(f"{db}.events"), ["event_id"], ["ds"])),
        ("Check: source and target counts as two scalar subqueries",
         spark.sql(count_equal_sql(f"{db}.lineitem", f"{db}.lineitem"))),
        ("Fused checks: four assertions, one scan of the table",
         fuse(spark, [f"SELECT count(*) > 0 FROM {db}.lineitem", f"SELECT count(*) > 0 FROM {db}.lineitem WHERE l_returnflag = 'R'",
                      f"SELECT min(l_discount) >= 0 FROM {db}.lineitem", f"SELECT (SELECT count(*) FROM {db}.lineitem) > 5 AS ok"]).queries.popitem()[1]),
        ("Fused checks, all filtered: partitions that no call concerns are pruned",
         fuse(spark, [f"SELECT count(*) > 0 FROM {db}.events_by_day WHERE ds = '2024-01-{d}'" for d in (15, 16)]).queries.popitem()[1]),
        ("Parallel row cap: named files, the last one by its row index, no limit", limit_rows(spark.read.parquet(capped), 10_000, parallel=True)),
        ("Difference: rows of unequal buckets of unequal partitions, then exceptAll both ways",
         difference(li.withColumn("l_tax", F.when(F.col("l_orderkey") == 7, F.lit(9.0)).otherwise(F.col("l_tax"))), spark.table(f"{db}.lineitem"), ["l_returnflag"])),
    ]
    print("# Physical plans of the main operations\n")
    print(f"Generated by `tools/show_plans.py` on `{sf}` (local mode, AQE on; plans before AQE re-planning).\n")
    for title, df in sections:
        print(f"## {title}\n\n```\n{plan(df)}\n```\n")


if __name__ == "__main__":
    main()
