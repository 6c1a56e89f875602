"""Every registered query against its SQL, and the entry point."""

import pytest

import compare
from snapmart.driver import oracle, registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.duck(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle.statements()) <= set(compare.spark_entry.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_agrees_with_sql(spark, connection, name):
    assert compare.difference(spark, connection, SF_DIR, name) is None


def test_entry(spark):
    assert compare.spark_entry.entry(spark).count() > 0
