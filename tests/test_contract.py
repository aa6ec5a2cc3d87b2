"""Registered queries against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_result(spark, con, name):
    assert compare(spark, con, FOLDER, name).startswith("OK")


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 400
