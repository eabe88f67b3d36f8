"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import difference, duck
from tidemark.registry.oracle import ORACLE
from tidemark.registry.queries import QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def db():
    return duck(SF)


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    assert difference(spark, db, name, QUERIES[name], entry.oracle_sql()[name], SF) is None


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["order_id", "customer_id", "customer_sk"]
