"""Every registered query against its oracle."""

from __future__ import annotations

import os

import pytest
from compare import differences, oracle_connection

import __spark_entry__ as entry_points
from checks import queries as registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_agrees_with_oracle(spark, connection, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    assert differences(df, connection, entry_points.oracle_sql()[name]) is None


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_entry_has_rows(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0
    assert df.columns[:5] == ["year", "month", "day", "dayname", "season"]
