import os
import sys
import uuid

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tidemark.session import local_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tidemark-tests", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A new shared folder for one test."""
    return scratch_path(spark, f"test-{uuid.uuid4().hex[:6]}")
