"""Deadlines, retries and the order of a batch."""

import threading
import time

import pytest

from carryover.jobs import DeadlineExceeded, deadline, may_pass
from carryover.plans import MigrationOptions, run_migration
from carryover.plans import batch
from carryover.sources import ParquetSource
from conftest import SF001

REFS = [f"{SF001}/{t}.parquet" for t in ("region", "nation", "customer")]


def _slow(df, seconds):
    def slowly(batches):
        import time

        time.sleep(seconds)
        yield from batches

    return df.mapInPandas(slowly, df.schema)


class Slow(ParquetSource):
    def read(self, spark, ref):
        df = super().read(spark, ref)
        return _slow(df, 60) if "nation" in ref else df


def _report(df):
    return {r["source"].rsplit("/", 1)[1].split(".")[0]: r for r in df.collect()}


def test_deadline_cancels_only_its_own_jobs(spark):
    out = {}

    def other():
        out["rows"] = _slow(spark.range(5), 3).count()

    thread = threading.Thread(target=other)
    thread.start()
    start = time.time()
    with pytest.raises(DeadlineExceeded, match="after 1 s"):
        with deadline(spark, 1):
            _slow(spark.range(5), 60).count()
    assert time.time() - start < 30
    thread.join()
    assert out == {"rows": 5}
    assert not list(spark.sparkContext.getJobTags())


def test_deadline_lets_work_and_errors_through(spark):
    with deadline(spark, 60):
        assert spark.range(3).count() == 3
    with pytest.raises(KeyError):
        with deadline(spark, 60):
            raise KeyError("own")
    with deadline(spark, None):
        assert spark.range(3).count() == 3


@pytest.mark.parametrize("parallelism", [1, 3])
def test_slow_table_is_cancelled_and_the_others_finish(spark, db, parallelism):
    limits = {REFS[1]: 2}
    rep = _report(run_migration(spark, Slow(), REFS, MigrationOptions(database=db), parallelism=parallelism, timeout=limits))
    assert {k: r["status"] for k, r in rep.items()} == {"region": "success", "nation": "timed out", "customer": "success"}
    assert rep["nation"]["error"] == "cancelled after 2 s"
    assert not spark.catalog.tableExists(f"{db}.nation")
    again = run_migration(spark, ParquetSource(), [REFS[1]], MigrationOptions(database=db)).first()  # the name and folder are free
    assert (again["status"], again["target_rows"]) == ("success", 25), again


def test_timed_out_append_adds_nothing_and_says_what_is_there(spark, db):
    run_migration(spark, ParquetSource(), [REFS[1]], MigrationOptions(database=db)).collect()
    rep = run_migration(spark, Slow(), [REFS[1]], MigrationOptions(database=db, mode="append"), timeout=2).first()
    assert (rep["status"], rep["target_rows"]) == ("timed out", 25), rep
    assert spark.table(f"{db}.nation").count() == 25


def test_create_cancelled_in_its_check_leaves_no_table(spark, db, monkeypatch):
    def landed_then_slow(spark, source, ref, options, target_name=None):
        spark.range(3).write.saveAsTable(f"{db}.{target_name}")
        _slow(spark.range(1), 60).count()

    monkeypatch.setattr(batch, "migrate_table", landed_then_slow)
    rep = run_migration(spark, ParquetSource(), [REFS[0]], MigrationOptions(database=db), timeout=3).first()
    assert rep["status"] == "timed out" and not spark.catalog.tableExists(f"{db}.region")


def test_a_table_that_was_there_is_not_dropped(spark, db):
    spark.range(2).write.saveAsTable(f"{db}.region")
    rep = run_migration(spark, ParquetSource(), [REFS[0]], MigrationOptions(database=db), retries=2).first()
    assert rep["status"] == "failed" and spark.table(f"{db}.region").count() == 2


@pytest.mark.parametrize("mode, tries", [("create", 3), ("append", 1)])
def test_errors_that_may_pass_are_tried_again(spark, db, monkeypatch, mode, tries):
    real, calls = batch.migrate_table, []

    def flaky(spark, source, ref, options, target_name=None):
        calls.append(ref)
        if len(calls) < 3:
            spark.range(1).write.mode("append").saveAsTable(f"{db}.{target_name}")
            raise ConnectionError("reset")
        return real(spark, source, ref, options, target_name=target_name)

    monkeypatch.setattr(batch, "migrate_table", flaky)
    monkeypatch.setattr(batch.time, "sleep", lambda s: None)
    if mode == "append":
        spark.read.parquet(REFS[0]).write.saveAsTable(f"{db}.region2")
    rep = run_migration(spark, ParquetSource(), [REFS[0]], MigrationOptions(database=db, mode=mode), retries=5).first()
    assert len(calls) == tries
    assert rep["status"] == ("success" if mode == "create" else "failed")


def test_what_may_pass(spark):
    assert may_pass(RuntimeError("Job aborted: ExecutorLostFailure (executor 3 exited)"))
    assert may_pass(TimeoutError())
    assert not may_pass(ValueError("Connection refused"))
    assert not may_pass(DeadlineExceeded("x"))
    with pytest.raises(Exception) as caught:
        spark.sql("SELECT nope").collect()
    assert not may_pass(caught.value)
    with pytest.raises(Exception) as caught:
        spark.sql("SELECT CAST('x' AS INT)").collect()
    assert not may_pass(caught.value)


def test_largest_input_goes_first_and_the_report_keeps_its_order(spark, db, monkeypatch):
    real, seen = batch.migrate_table, []

    def noted(spark, source, ref, options, target_name=None):
        seen.append(target_name)
        return real(spark, source, ref, options, target_name=target_name)

    monkeypatch.setattr(batch, "migrate_table", noted)
    refs = [REFS[0], "/no/such.parquet", REFS[2], REFS[1]]
    rep = run_migration(spark, ParquetSource(), refs, MigrationOptions(database=db), longest_first=True).collect()
    assert [n.strip("`") for n in seen][0] == "customer" and [n.strip("`") for n in seen][-1] == "such"
    assert [r["source"] for r in rep] == refs
    with pytest.raises(ValueError):
        run_migration(spark, ParquetSource(), refs, MigrationOptions(database=db), retries=-1)
