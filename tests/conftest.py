import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quotewright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = build_session(
        "quotewright-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=warehouse,
        spark__driver__memory="6g",
        # Many small day partitions: list them without starting a job.
        spark__sql__sources__parallelPartitionDiscovery__threshold="10000",
    )
    session.sparkContext.setLogLevel("ERROR")
    # Plans are compared as text; do not cut their filter lists short.
    session.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
