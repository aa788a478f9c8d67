import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from curbstar.session import local_session

    session = local_session("tests", int(os.environ.get("TEST_CPUS", "8")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    from comparison import connect

    return connect(sf_dir)


@pytest.fixture
def column(spark):
    """Evaluate a column expression for each row of (values, schema)."""

    def evaluate(rows, schema, expression):
        df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
        indexed = df.coalesce(1).select(expression.alias("out"))
        return [row["out"] for row in indexed.collect()]

    return evaluate
