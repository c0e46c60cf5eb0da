"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from paperloom import registry
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    assert differences(spark, duck, name, SF) == []


def test_every_query_has_sql():
    assert set(registry.ORACLE_SQL) == set(registry.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and {"source", "files", "bytes", "shards"} <= set(rows[0].asDict())
