import pytest

from carryover.plans import can_register, catalog_settings, session_settings
from carryover.sources import CatalogSource, ParquetSource, get_source, s3a_settings


def test_catalog_kinds():
    h = catalog_settings("hadoop", "ice", warehouse="s3a://wh/")
    assert h["spark.sql.catalog.ice.type"] == "hadoop"
    n = catalog_settings("nessie", uri="http://n/iceberg/", warehouse="wh")
    assert n["spark.sql.catalog.iceberg.type"] == "rest"
    g = catalog_settings("glue", warehouse="s3://wh/", region="eu-west-1")
    assert g["spark.sql.catalog.iceberg.region"] == "eu-west-1"
    assert "catalog-impl" in "".join(g)
    s = catalog_settings("s3_tables", warehouse="arn:x")
    assert s["spark.sql.catalog.iceberg.warehouse"] == "arn:x"
    assert catalog_settings("session") == {}
    with pytest.raises(ValueError):
        catalog_settings("bogus")
    with pytest.raises(ValueError):
        catalog_settings("hadoop")  # needs a warehouse


def test_s3_tables_cannot_register():
    assert can_register("hadoop") and can_register("session")
    assert not can_register("s3_tables")


def test_storage_settings_global_and_bucket():
    assert s3a_settings(None) == {}
    g = s3a_settings("http://localhost:9000", "k", "s")
    assert g["spark.hadoop.fs.s3a.endpoint"] == "http://localhost:9000"
    assert g["spark.hadoop.fs.s3a.path.style.access"] == "true"
    b = s3a_settings("http://m:9000", "k", "s", bucket="raw", path_style_access=False)
    assert b["spark.hadoop.fs.s3a.bucket.raw.endpoint"] == "http://m:9000"
    assert b["spark.hadoop.fs.s3a.bucket.raw.path.style.access"] == "false"


def test_session_settings_order_and_overrides():
    src = get_source("hive", metastore_uri="thrift://h:9083", database="shop")
    st = session_settings(
        source=src,
        catalog_kind="hadoop",
        catalog_options={"warehouse": "/wh"},
        extra_packages=["g:a:1", ""],
        extra_config={"spark.sql.catalog.iceberg.type": "override"},
    )
    assert st["spark.sql.catalogImplementation"] == "hive"
    assert st["spark.jars.packages"] == "g:a:1"
    assert st["spark.sql.catalog.iceberg.type"] == "override"  # extra config applied last


def test_source_registry():
    assert isinstance(get_source("parquet"), ParquetSource)
    assert isinstance(get_source("catalog", database="d"), CatalogSource)
    with pytest.raises(ValueError):
        get_source("hive")
    with pytest.raises(ValueError):
        get_source("jdbc")
    src = CatalogSource(database="shop")
    assert src.resolve("yellow") == "`shop`.`yellow`"
    assert src.target_name("other.green") == "green"
    assert ParquetSource().target_name("s3a://raw/yellow_tripdata") == "yellow_tripdata"


def test_sources_satisfy_the_pluggable_interface():
    from carryover.sources import Source

    assert isinstance(CatalogSource(), Source) and isinstance(ParquetSource(), Source)
    assert get_source("hive", metastore_uri="thrift://m:9083").session_settings()["spark.hadoop.hive.metastore.uris"] == "thrift://m:9083"
    assert ParquetSource().session_settings() == {}
