"""Every registered query against its SQL counterpart, on the smallest tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, connect
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    same, line = compare(spark, con, SF, name)
    assert same, line


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
