import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from trisketch.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def edges_of(spark):
    def build(pairs):
        return spark.createDataFrame(list(pairs), "u bigint, v bigint")

    return build


@pytest.fixture
def items_of(spark):
    def build(values):
        return spark.createDataFrame([(v,) for v in values], "item bigint")

    return build
