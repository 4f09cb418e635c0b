import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMALL_SF = os.environ.get("ORDERLENS_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from orderlens.session import local_session

    s = local_session("*", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL_SF


@pytest.fixture(scope="module", autouse=True)
def no_views_left(spark):
    """Temporary views of a module's tests go with it: they are in every database's list of tables."""
    yield
    for t in spark.catalog.listTables():
        if t.isTemporary:
            spark.catalog.dropTempView(t.name)
