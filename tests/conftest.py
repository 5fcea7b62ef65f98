from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pricecube.session import get_session

    s = get_session("local[4]", app_name="pricecube-tests", shuffle_partitions=4, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="pricecube-test-ckpt-"), "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="pricecube-test-wh-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="pricecube-test-")
