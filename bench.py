"""Bench: headline copy / register / validate operations at one scale factor.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
``/root/testdata/sf0.1``) and prints ONE JSON line.  The JVM is warmed
first with the same operations on sf0.001, then every query is timed
``$BENCH_REPEAT`` times (default 3) and its median is reported.
Writes go to the shared scratch folder of the session
(``spark.checkpoint.dir``).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from carryover.operators import (  # noqa: E402
    export_partitioned,
    fingerprint,
    fingerprint_pair,
    partition_stats,
    register_files,
    replicate_partitions,
    write_table,
)
from carryover.plans import (  # noqa: E402
    MigrationOptions,
    migrate_table,
    parse_checks,
    register_check_text,
    run_checks,
    run_migration,
)
from carryover.session import local_session, scratch_database, scratch_path  # noqa: E402
from carryover.sources import ParquetSource  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_DIR = "/root/testdata/sf0.001"
REPEAT = max(1, int(os.environ.get("BENCH_REPEAT", "3")))


def _read(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def q_count(spark, sf):
    """A1: count the rows of the lineitem file (footer-only)."""
    return _read(spark, sf, "lineitem").count()


def q_copy(spark, sf):
    """K1: copy lineitem to a new table; rows counted by the write itself."""
    db, _ = scratch_database(spark, "bench")
    return write_table(_read(spark, sf, "lineitem"), f"{db}.lineitem", "create").rows


def q_copy_partitioned(spark, sf):
    """Copy lineitem partitioned by l_returnflag (rebalanced)."""
    db, _ = scratch_database(spark, "bench")
    return write_table(_read(spark, sf, "lineitem"), f"{db}.lineitem", "create", partition_by=["l_returnflag"]).rows


def setup_multifile(spark, sf):
    """lineitem as 32 files, the shape of a real table (the test files are one row group each)."""
    path = scratch_path(spark, "bench_multi")
    _read(spark, sf, "lineitem").repartition(32).write.parquet(path)
    return path


def q_copy_multifile(spark, sf, path):
    """K1 over a 32-file input: one task per file, all cores busy, no shuffle."""
    db, _ = scratch_database(spark, "bench")
    return write_table(spark.read.parquet(path), f"{db}.lineitem", "create").rows


def q_copy_partitioned_multifile(spark, sf, path):
    """T2 over a 32-file input: rebalanced on l_returnflag: 3 files, where a plain partitioned write makes 24."""
    db, _ = scratch_database(spark, "bench")
    return write_table(spark.read.parquet(path), f"{db}.lineitem", "create", partition_by=["l_returnflag"]).rows


def q_copy_verified(spark, sf):
    """V6 content: copy lineitem with a fingerprint on the write, then fingerprint the target once."""
    db, _ = scratch_database(spark, "bench")
    df = _read(spark, sf, "lineitem")
    w = write_table(df, f"{db}.lineitem", "create", fingerprint=True)
    fp = fingerprint(spark.table(f"{db}.lineitem"), df.columns)
    assert fp == w.fingerprint, (fp, w.fingerprint)
    return w.rows


def setup_content_compare(spark, sf):
    db, _ = scratch_database(spark, "bench")
    write_table(_read(spark, sf, "lineitem"), f"{db}.lineitem", "create")
    return f"{db}.lineitem"


def q_content_compare(spark, sf, copy):
    """Content of the lineitem file vs an existing copy, both directions at once (vs exceptAll)."""
    df = _read(spark, sf, "lineitem")
    a, b = fingerprint_pair(df, spark.table(copy))
    assert a == b, (a, b)
    return True


def setup_append_day(spark, sf):
    db, _ = scratch_database(spark, "bench")
    ev = _read(spark, sf, "events").withColumn("ds", F.to_date("ts"))
    write_table(ev.where("ds <> DATE '2024-01-15'"), f"{db}.events", "create", partition_by=["ds"])
    day = scratch_path(spark, "bench_day")
    ev.where("ds = DATE '2024-01-15'").write.parquet(day)
    return db, day


def q_append_day(spark, sf, prepared):
    """K3 + V6: one day appended to a partitioned table; validation reads only that day."""
    db, day = prepared
    row = migrate_table(spark, ParquetSource(), day, MigrationOptions(database=db, mode="append"), target_name="events")
    assert row["status"] == "success", row
    return row["added_rows"]


def q_migrate_batch(spark, sf):
    """O1/O2: batch of lineitem, orders, customer, part with count validation."""
    db, _ = scratch_database(spark, "bench")
    refs = [f"{sf}/{n}.parquet" for n in ("lineitem", "orders", "customer", "part")]
    rows = run_migration(spark, ParquetSource(), refs, MigrationOptions(database=db), parallelism=4).collect()
    assert all(r["status"] == "success" for r in rows), rows
    return sum(r["source_rows"] for r in rows)


def q_export_register(spark, sf):
    """K7+K4: export events by day, register the tree as a table, compare counts."""
    path = scratch_path(spark, "bench_ev")
    ev = _read(spark, sf, "events").withColumn("ds", F.date_format("ts", "yyyy-MM-dd"))
    export_partitioned(ev, path, ["ds"])
    db, _ = scratch_database(spark, "bench")
    reg = register_files(spark, path, f"{db}.events", partition_columns=["ds"])
    assert reg.status == "success"
    return reg.target_rows


def setup_register(spark, sf):
    paths = []
    ev = _read(spark, sf, "events").withColumn("ds", F.date_format("ts", "yyyy-MM-dd"))
    for _ in range(REPEAT):  # one fresh tree per timed run
        path = scratch_path(spark, "bench_reg")
        export_partitioned(ev, path, ["ds"])
        paths.append(path)
    return paths


def q_register(spark, sf, paths):
    """K4 alone: an existing ds= tree made a table (no data rewritten), counts compared."""
    path = paths.pop() if len(paths) > 1 else paths[0]
    db, _ = scratch_database(spark, "bench")
    reg = register_files(spark, path, f"{db}.events", partition_columns=["ds"])
    assert reg.status == "success"
    return reg.target_rows


def q_replicate_export(spark, sf):
    """T5+K7: orders written once per ds value, one scan, partition counts returned."""
    path = scratch_path(spark, "bench_rep")
    ex = export_partitioned(replicate_partitions(_read(spark, sf, "orders"), "ds", ["2024-01-15", "2024-01-16"]), path, ["ds"])
    return ex.partitions.agg(F.sum("n_rows")).first()[0]


def q_file_stats(spark, sf):
    """Per-file min/max/null statistics of lineitem rolled up per l_returnflag."""
    df = _read(spark, sf, "lineitem")
    return partition_stats(df.withColumn("flag", F.col("l_returnflag")), ["l_orderkey", "l_shipdate"], ["flag"]).count()


def q_checks(spark, sf):
    """V1–V5: registration checks over a registered events table."""
    path = scratch_path(spark, "bench_chk")
    ev = _read(spark, sf, "events").withColumn("ds", F.date_format("ts", "yyyy-MM-dd"))
    export_partitioned(ev, path, ["ds"])
    db, _ = scratch_database(spark, "bench")
    register_files(spark, path, f"{db}.events", count=False)
    run = run_checks(spark, parse_checks(register_check_text([f"{db}.events"], "ds", "2024-01-15")), parallelism=4)
    assert run.failed == 0
    return run.passed


# --- the plain Spark calls beside ours, timed in the same process


def p_copy(spark, sf):
    db, _ = scratch_database(spark, "bench")
    _read(spark, sf, "lineitem").write.saveAsTable(f"{db}.lineitem")
    return spark.table(f"{db}.lineitem").count()


def p_copy_partitioned(spark, sf):
    db, _ = scratch_database(spark, "bench")
    _read(spark, sf, "lineitem").write.partitionBy("l_returnflag").saveAsTable(f"{db}.lineitem")
    return spark.table(f"{db}.lineitem").count()


def p_content_compare(spark, sf, copy):
    a, b = _read(spark, sf, "lineitem"), spark.table(copy)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def p_replicate_export(spark, sf):
    path = scratch_path(spark, "bench_rep")
    both = _read(spark, sf, "orders").withColumn("ds", F.explode(F.array(F.lit("2024-01-15"), F.lit("2024-01-16"))))
    both.write.mode("append").partitionBy("ds").parquet(path)
    return spark.read.parquet(path).groupBy("ds").count().collect()


PLAIN = {
    "count": q_count,
    "copy": p_copy,
    "copy_partitioned": p_copy_partitioned,
    "content_compare": p_content_compare,
    "replicate_export": p_replicate_export,
}

SETUP = {
    "content_compare": setup_content_compare,
    "append_day": setup_append_day,
    "register": setup_register,
    "copy_multifile": setup_multifile,
    "copy_partitioned_multifile": setup_multifile,
}  # untimed preparation, its result is passed on

QUERIES = {
    "count": q_count,
    "copy": q_copy,
    "copy_partitioned": q_copy_partitioned,
    "copy_multifile": q_copy_multifile,
    "copy_partitioned_multifile": q_copy_partitioned_multifile,
    "copy_verified": q_copy_verified,
    "content_compare": q_content_compare,
    "append_day": q_append_day,
    "migrate_batch": q_migrate_batch,
    "export_register": q_export_register,
    "register": q_register,
    "replicate_export": q_replicate_export,
    "file_stats": q_file_stats,
    "checks": q_checks,
}


def main() -> None:
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):  # stage and task times, read with tools/stage_times.py
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]}
    spark = local_session(CPUS, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")), **extra)
    for name, fn in QUERIES.items():  # warm-up on the smallest scale
        extra = (SETUP[name](spark, WARM_DIR),) if name in SETUP else ()
        fn(spark, WARM_DIR, *extra)
    times: dict[str, float] = {}
    plain: dict[str, float] = {}  # the same work by bare Spark calls
    for name, fn in QUERIES.items():
        extra = (SETUP[name](spark, SF_DIR),) if name in SETUP else ()
        runs = []
        for _ in range(REPEAT):
            t0 = time.perf_counter()
            fn(spark, SF_DIR, *extra)
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
        if name in PLAIN:
            runs = []
            for _ in range(REPEAT):
                t0 = time.perf_counter()
                PLAIN[name](spark, SF_DIR, *extra)
                runs.append(time.perf_counter() - t0)
            plain[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)$", SF_DIR)
    sf = float(m.group(1)) if m else None
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf,
                "repeat": REPEAT,
                "plain_spark": plain,
            }
        )
    )


if __name__ == "__main__":
    main()
