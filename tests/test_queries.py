"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import pytest

import harness.queries  # noqa: F401  registers everything
from harness.check import compare, connect
from harness.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, sf_dir, connection, key):
    assert compare(spark, connection, sf_dir, key) == []


def test_registered():
    assert set(ORACLES) == set(QUERIES)
