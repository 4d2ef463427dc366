import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tools.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """A DataFrame of one ``value`` column."""
    return lambda *values: spark.createDataFrame([(v,) for v in values], "value string")
