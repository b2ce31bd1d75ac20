"""Methods the JVM compiles, in sessions of any settings."""

from __future__ import annotations

import pytest

from courtlake.session import METHOD_LIMIT_CONF, compiled, written_once


@pytest.fixture()
def wide_limit(spark):
    before = spark.conf.get(METHOD_LIMIT_CONF)
    spark.conf.set(METHOD_LIMIT_CONF, "65535")
    yield
    spark.conf.set(METHOD_LIMIT_CONF, before)


def test_methods_are_split_while_a_job_writes(spark, wide_limit, monkeypatch):
    limits = []
    writer = type(spark.range(1).write)
    monkeypatch.setattr(writer, "parquet", lambda self, path, f=writer.parquet: (
        limits.append(spark.conf.get(METHOD_LIMIT_CONF)), f(self, path))[1])
    assert written_once(spark, spark.range(3), "limit").count() == 3
    assert limits == ["8000"] and spark.conf.get(METHOD_LIMIT_CONF) == "65535"


def test_the_limit_of_the_session_comes_back(spark, wide_limit):
    with pytest.raises(ValueError), compiled(spark):
        raise ValueError
    assert spark.conf.get(METHOD_LIMIT_CONF) == "65535"
    spark.conf.set(METHOD_LIMIT_CONF, "100")
    with compiled(spark):
        assert spark.conf.get(METHOD_LIMIT_CONF) == "100"
