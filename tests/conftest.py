import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from review_topics.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("8", "tests", **{"spark.sql.shuffle.partitions": "2", "spark.default.parallelism": "2"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL
