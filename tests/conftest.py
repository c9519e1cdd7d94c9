import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from textloom.session import build_session

    os.environ.setdefault(
        "PYSPARK_SUBMIT_ARGS",
        "--driver-memory 4g --conf spark.ui.enabled=false --conf spark.ui.showConsoleProgress=false pyspark-shell",
    )
    session = build_session("tests", "local[8]")
    session.conf.set("spark.sql.shuffle.partitions", "8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="textloom-test-")
