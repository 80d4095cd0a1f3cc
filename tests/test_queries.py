"""Every query against its SQL, on the smallest data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_queries import compare, duck
from workload.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) == ""


def test_entry_names_them_all():
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_every_query_has_sql():
    assert ROWS_ONLY == []


def test_entry(spark):
    assert entry(spark).count() > 0
