import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from rastertab.session import build_session

    wh = tempfile.mkdtemp(prefix="rastertab-wh-")
    s = build_session("local[4]", app="rastertab-tests", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": wh,
        "spark.driver.memory": "4g",
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="rastertab-test-")
