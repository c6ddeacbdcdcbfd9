import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from ledgerflow.session import build_session
    s = build_session("local[4]", app="ledgerflow-tests", shuffle_partitions=8, extra={
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ledgerflow-test-ckpt-"),
        "spark.driver.memory": "4g",
    })
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="ledgerflow-test-")
