from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for path in (ROOT, os.path.join(ROOT, "tests")):
    if path not in sys.path:
        sys.path.insert(0, path)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from regulus.session import build_session
    session = build_session(
        "tests", master="local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
           "spark.default.parallelism": "4", "spark.sql.session.timeZone": "UTC"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    from compare import connect
    return connect(sf_dir)
