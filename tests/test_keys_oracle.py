"""Every registered query key against its DuckDB oracle, as the driver's gate does."""

import datetime
import decimal

import duckdb
import pytest

from carryover.keys import KEYS, ORACLES
from conftest import SF001, SF01

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


# DuckDB result types and the Spark types they correspond to (the gate also compares schemas).
DUCK_TO_SPARK = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DOUBLE": "double",
    "FLOAT": "float",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(round(v, 6))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


def test_every_key_has_an_oracle():
    assert set(KEYS) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(KEYS))
def test_key_matches_oracle(spark, duck, key):
    df = KEYS[key](spark, SF01)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in df.collect())
    rel = duck.sql(ORACLES[key])
    ocols = rel.columns
    assert sorted(ocols) == cols
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck_types = {c: DUCK_TO_SPARK.get(str(t).split("(")[0], str(t)) for c, t in zip(ocols, rel.types)}
    assert spark_types == duck_types
    order = sorted(range(len(ocols)), key=lambda i: ocols[i])
    want = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rel.fetchall())
    assert got == want


def test_entry_smoke(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    rows = df.collect()
    assert df.columns == ["tbl", "source_rows", "target_rows", "status"]
    assert {r["status"] for r in rows} == {"success"}
    assert SF001  # entry reads the smoke scale


@pytest.mark.parametrize("key", ["export_partitioned", "partition_prune", "register_typed", "append_partitioned"])
def test_date_keys_do_not_depend_on_the_session_time_zone(spark, duck, key):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        test_key_matches_oracle(spark, duck, key)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
