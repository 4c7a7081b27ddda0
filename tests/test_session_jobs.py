from carryover.jobs import labelled
from carryover.session import scratch_database, scratch_path, scratch_root


def test_scratch_names_are_unique_and_under_the_checkpoint_folder(spark):
    root = scratch_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)
    db1, loc1 = scratch_database(spark, "y")
    db2, _ = scratch_database(spark, "y")
    assert db1 != db2 and spark.catalog.databaseExists(db1) and loc1.startswith(root)


def test_labels_apply_inside_and_are_restored(spark):
    sc = spark.sparkContext
    sc.setLocalProperty("spark.job.description", "outer")
    try:
        with labelled(spark, "inner work", pool="p1"):
            assert sc.getLocalProperty("spark.job.description") == "inner work"
            assert sc.getLocalProperty("spark.scheduler.pool") == "p1"
            spark.range(3).count()
        assert sc.getLocalProperty("spark.job.description") == "outer"
        assert sc.getLocalProperty("spark.scheduler.pool") is None
    finally:
        sc.setLocalProperty("spark.job.description", None)
