import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from satmart.session import local_session

    session = local_session(8, "tests", **{
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="satmart-tests-"),
    })
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A small DataFrame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def workdir():
    return tempfile.mkdtemp(prefix="satmart-case-")
