"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from catalog.queries import REGISTRY
from tests.compare import compare, database

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(SF)


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(entry.queries()) and set(REGISTRY) <= set(entry.oracle_sql())


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, db, name):
    assert compare(spark, db, SF, name, entry.queries()[name], entry.oracle_sql()[name]) is None
