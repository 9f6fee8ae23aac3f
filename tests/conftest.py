import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from giftlink.session import get_spark
    s = get_spark("local[4]", 4, app="giftlink-tests",
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="giftlink-test-wh-")})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="giftlink-test-ckpt-"))
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="giftlink-test-")
