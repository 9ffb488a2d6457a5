import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from monthmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", 8, **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


def rows(df):
    """The rows of a small result as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    """The physical plan before it runs; a finished one would list its stages twice."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString()
