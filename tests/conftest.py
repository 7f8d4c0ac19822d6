import os
import sys
import tempfile

# Linear algebra in the driver with a pool of threads has come to a standstill beside Spark's.
os.environ.setdefault("OMP_NUM_THREADS", "1")
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")

import pytest  # noqa: E402

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidegauge.session import build_session  # noqa: E402


def make_session():
    session = build_session(
        "tidegauge-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            # a long session of short queries: do not keep the plans of all of them
            "spark.sql.ui.retainedExecutions": "20",
            "spark.ui.retainedJobs": "50",
            "spark.ui.retainedStages": "50",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidegauge-test-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
