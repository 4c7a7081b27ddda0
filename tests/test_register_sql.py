"""The statements the register path sends, checked as text (the V2 procedure cannot run offline)."""

from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from carryover.operators import Layout, add_files_sql, create_table_sql


def _layout():
    nested = StructType([StructField("a b", IntegerType())])
    schema = StructType(
        [
            StructField("ds", DateType()),
            StructField("id", LongType()),
            StructField("s", nested),
            StructField("note", StringType()),
        ]
    )
    return Layout(schema=schema, partition_columns=("ds",))


def test_create_table_sql_puts_partition_columns_last_and_quotes_nested_names(spark):
    sql = create_table_sql("iceberg.db.t", _layout(), fmt="iceberg", location=None)
    assert sql.startswith("CREATE TABLE IF NOT EXISTS `iceberg`.`db`.`t` (")
    assert "USING iceberg PARTITIONED BY (`ds`)" in sql and "LOCATION" not in sql
    body = sql[sql.index("(") + 1 : sql.index(") USING")]
    assert body.index("id") < body.index("note") < body.index("ds")
    assert "`a b`" in body  # nested field name quoted, so the DDL parses


def test_session_catalog_ddl_parses(spark, db):
    sql = create_table_sql(f"{db}.ddl", _layout(), fmt="parquet", location="/tmp/x it's")
    assert sql.endswith("LOCATION '/tmp/x it\\'s'")
    spark.sql(sql)
    cols = {c.name: c.isPartition for c in spark.catalog.listColumns(f"{db}.ddl")}
    assert cols == {"id": False, "s": False, "note": False, "ds": True}


def test_add_files_call():
    sql = add_files_sql("iceberg", "iceberg.shop.yellow", "s3a://raw-parquet/yellow_tripdata")
    assert sql == (
        "CALL `iceberg`.system.add_files(table => 'shop.yellow', "
        "source_table => '`parquet`.`s3a://raw-parquet/yellow_tripdata`')"
    )
