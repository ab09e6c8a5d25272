import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from riskframe.session import build_session
    ck = tempfile.mkdtemp(prefix="rf-test-ckpt-")
    s = build_session("local[4]", app="riskframe-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ck, "spark.driver.memory": "4g"})
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
