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
    from changeflow.session import build_session, checkpoint_root
    s = build_session("local[*]", shuffle_partitions=8,
                      extra={"spark.sql.streaming.forceDeleteTempCheckpointLocation": "true"})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)          # unset in tests → a scratch folder is registered
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="changeflow-test-")
