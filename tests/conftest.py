import os
import sys
import tempfile
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millwright.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="mw-test-ckpt-")
    s = build_session("local[4]", app_name="millwright-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


T0 = datetime(2026, 5, 1, 6, 0, 0)


def ts(minutes=0.0, seconds=0.0, micros=0):
    return T0 + timedelta(minutes=minutes, seconds=seconds, microseconds=micros)
