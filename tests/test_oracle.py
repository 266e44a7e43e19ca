"""Every query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry
from clickloom.catalog import catalog as queries
from clickloom.oracle import oracle_sql
from tests.conftest import TABLES
from tests.oracle_check import compare, connect


@pytest.fixture(scope="module")
def duck():
    con = connect(TABLES)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_sql(spark, duck, name):
    assert compare(queries()[name](spark, TABLES), duck, oracle_sql()[name]) is None


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and rows == sorted(rows, key=lambda r: (-r.clicks, r.domain))
