"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest
from check_oracle import difference, kinds, oracle_connection

from adflow.plans.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, connection, key):
    got = QUERIES[key](spark, SF_DIR).toPandas()
    assert len(got) > 0
    expected = connection.execute(ORACLES[key]).df()
    assert difference(got, expected) is None
    assert kinds(got) == kinds(expected)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
