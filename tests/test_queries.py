"""Every registered query against its SQL twin, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from workload.oracles import ORACLES
from workload.queries import REGISTRY

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert set(REGISTRY) == set(ORACLES)
    assert set(REGISTRY) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, oracle, name):
    found = entry.queries()[name](spark, SMALL)
    cursor = oracle.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    columns = sorted(found.columns)
    assert columns == sorted(names)
    expected = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in cursor.fetchall())
    assert sorted(repr(tuple(row[c] for c in columns)) for row in found.collect()) == expected
