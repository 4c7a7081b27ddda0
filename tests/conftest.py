import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from carryover.session import local_session

    import tempfile

    # managed tables outside a scratch database must not land in the repository
    warehouse = tempfile.mkdtemp(prefix="carryover-test-warehouse-")
    session = local_session("*", shuffle_partitions=8, **{"spark.sql.warehouse.dir": warehouse})
    yield session


@pytest.fixture()
def db(spark):
    from carryover.session import scratch_database

    name, _ = scratch_database(spark, "t")
    return name


@pytest.fixture()
def scratch(spark):
    from carryover.session import scratch_path

    return lambda tag="x": scratch_path(spark, tag)
