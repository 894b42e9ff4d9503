"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as registry
from compare import difference, oracle_connection
from veilcount import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, connection, name):
    frame = registry.queries()[name](spark, SF)
    assert difference(frame, connection, registry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    assert registry.entry(spark).count() == 117
