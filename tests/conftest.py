import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from metricyard.session import build_session
    s = build_session("local[4]", app_name="metricyard-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "6g",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="metricyard-test-shared-")})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="metricyard-test-")


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)
