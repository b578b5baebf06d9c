from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from estate.session import local_session

    session = local_session(4, shuffle_partitions=4, app="estate-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def con(sf_dir):
    from tests.compare import duck

    return duck(sf_dir)


@pytest.fixture
def rows(spark):
    """Build a small DataFrame from tuples and a DDL schema."""

    def build(data, schema):
        return spark.createDataFrame(data, schema)

    return build
