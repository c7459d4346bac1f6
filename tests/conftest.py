import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodestrata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "lodestrata-tests", "6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


def column(spark, expression, value=None, kind="string"):
    """Value of a column expression over a single row."""
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression.alias("y")).first().y
