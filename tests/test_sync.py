"""Registered trees kept up to date by difference."""

import pytest

from carryover.operators import register_files, sync_partitions, write_table
from carryover.operators import sync
from carryover.operators.versions import delete_folder
from carryover.plans import MigrationOptions, run_migration
from carryover.sources import ParquetSource


class Recorder:
    """A session that notes the DDL it is asked for."""

    def __init__(self, spark):
        self.spark, self.ddl = spark, []

    def __getattr__(self, name):
        return getattr(self.spark, name)

    def sql(self, text):
        if text.startswith("ALTER"):
            self.ddl.append(text)
        return self.spark.sql(text)


def _tree(spark, path, days, mode="append"):
    texts = ", ".join(f"'{d}'" for d in days)
    spark.sql(f"SELECT id AS x, explode(array({texts})) AS d FROM range(3)").write.mode(mode).partitionBy("d").parquet(path)


def _parts(spark, table):
    return sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())


def test_only_the_difference_reaches_the_catalog(spark, db, scratch):
    path, table = scratch("sync"), f"{db}.sync"
    days = [f"2024-01-{i:02d}" for i in range(1, 21)]
    _tree(spark, path, days)
    reg = register_files(spark, path, table, incremental=True)
    assert reg.status == "success" and reg.synced == sync.Synced(20, 0, 0, 1)
    rec = Recorder(spark)
    assert sync_partitions(rec, table) == sync.Synced(0, 0, 20, 0) and rec.ddl == []
    _tree(spark, path, ["2024-02-01", "2024-02-02"])
    delete_folder(spark, f"{path}/d=2024-01-05")
    rec = Recorder(spark)
    assert sync_partitions(rec, table) == sync.Synced(2, 1, 19, 2)
    assert len(rec.ddl) == 2 and rec.ddl[0].count("PARTITION (") == 2 and rec.ddl[1].count("PARTITION (") == 1
    assert spark.table(table).count() == 3 * 21 == spark.read.parquet(path).count()


def test_batches(spark, db, scratch, monkeypatch):
    monkeypatch.setattr(sync, "BATCH", 4)
    path, table = scratch("sync"), f"{db}.sync"
    _tree(spark, path, [f"2024-01-{i:02d}" for i in range(1, 11)])
    assert register_files(spark, path, table, incremental=True).synced == sync.Synced(10, 0, 0, 3)


def test_values_are_compared_by_type(spark, db, scratch):
    path, table = scratch("sync"), f"{db}.n"
    spark.range(2).write.parquet(f"{path}/n=01")
    spark.range(2).write.parquet(f"{path}/n=__HIVE_DEFAULT_PARTITION__")
    register_files(spark, path, table, incremental=True)
    assert sync_partitions(spark, table).statements == 0
    assert sorted((r["n"] is None, r["n"] or 0) for r in spark.table(table).select("n").distinct().collect()) == [(False, 1), (True, 0)]
    assert spark.table(table).count() == 4
    spark.range(2).write.parquet(f"{path}/n=1")
    with pytest.raises(ValueError, match="hold one partition"):
        sync_partitions(spark, table)


def test_odd_values_and_several_columns(spark, db, scratch):
    path, table = scratch("sync"), f"{db}.odd"
    odd = ["a/b", "a+b", "50%", "x=y", "it''s", "ü n", "per%20cent"]
    texts = ", ".join(f"'{o}'" for o in odd)
    spark.sql(f"SELECT id AS x, explode(array({texts})) AS p, CAST(id AS INT) AS q FROM range(2)").write.partitionBy("p", "q").parquet(path)
    reg = register_files(spark, path, table, incremental=True, partition_types={"p": "string"})
    assert (reg.status, reg.synced.added) == ("success", 14)
    assert sorted({r["p"] for r in spark.table(table).collect()}) == sorted(o.replace("''", "'") for o in odd)
    assert sync_partitions(spark, table) == sync.Synced(0, 0, 14, 0)
    delete_folder(spark, f"{path}/p=a+b")
    assert sync_partitions(spark, table) == sync.Synced(0, 2, 12, 1)


def test_folders_that_cannot_be_partitions_stop_before_any_statement(spark, db, scratch):
    path, table = scratch("sync"), f"{db}.bad"
    _tree(spark, path, ["2024-01-01"])
    register_files(spark, path, table, incremental=True)
    _tree(spark, path, ["2024-01-02"])
    spark.range(1).write.parquet(f"{path}/d=never")
    with pytest.raises(ValueError, match="d=never"):
        sync_partitions(spark, table)
    delete_folder(spark, f"{path}/d=never")
    spark.range(1).write.parquet(f"{path}/d=2024-01-02/h=1")
    with pytest.raises(ValueError, match="is no partition"):
        sync_partitions(spark, table)
    assert _parts(spark, table) == ["d=2024-01-01"]


def test_empty_folders_managed_and_unpartitioned_tables(spark, db, scratch):
    path, table = scratch("sync"), f"{db}.few"
    _tree(spark, path, ["2024-01-01", "2024-01-02"])
    register_files(spark, path, table, incremental=True)
    delete_folder(spark, f"{path}/d=2024-01-01")
    delete_folder(spark, f"{path}/d=2024-01-02")
    assert sync_partitions(spark, table) == sync.Synced(0, 2, 0, 1)
    assert spark.table(table).count() == 0
    write_table(spark.range(4).selectExpr("id", "id % 2 AS p"), f"{db}.own", "create", partition_by=("p",))
    with pytest.raises(ValueError, match="managed"):
        sync_partitions(spark, f"{db}.own")
    flat = scratch("flat")
    spark.range(3).write.parquet(flat)
    reg = register_files(spark, flat, f"{db}.flat", incremental=True)
    assert (reg.status, reg.synced) == ("success", sync.Synced(0, 0, 0, 0))


def test_incremental_registration_in_a_batch_matches_the_repair(spark, db, scratch):
    path = scratch("sync")
    _tree(spark, path, ["2024-01-01", "2024-01-02"])
    for name, incremental in (("fast", True), ("full", False)):
        opts = MigrationOptions(database=db, mode="register", incremental=incremental, verify="content")
        rep = run_migration(spark, ParquetSource(), [path], opts, targets={path: name}).first()
        assert (rep["status"], rep["target_rows"]) == ("success", 6), rep
    assert _parts(spark, f"{db}.fast") == _parts(spark, f"{db}.full")
