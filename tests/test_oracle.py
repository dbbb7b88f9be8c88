"""Every registered query equals its SQL on the given tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
import catalogue
from lanecost.operators.rules import RuleViolation

SF_DIR = "/root/testdata/sf0.001"
# In the smallest tables a few line items share their four-part key, so a load
# refuses them, as it should; loads are compared on the next size.
LARGER = "/root/testdata/sf0.01"
LOADS = ("load_run", "incremental_batch", "load_two_sources", "maintained_measures")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
QUERIES = {name: query for name, query in entry_module.queries().items() if name in catalogue.QUERIES}
ORACLE = {name: sql for name, sql in entry_module.oracle_sql().items() if name in QUERIES}
SPARK_TYPES = {
    "VARCHAR": "string",
    "INTEGER": "int",
    "TIMESTAMP": "timestamp_ntz",
}


@pytest.fixture(scope="module")
def duck():
    """A connection per folder, the tables of the folder as views."""
    connections = {}
    for folder in (SF_DIR, LARGER):
        connections[folder] = duckdb.connect()
        for name in TABLES:
            view = f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'"
            connections[folder].execute(view)
    yield connections
    for connection in connections.values():
        connection.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    folder = LARGER if name in LOADS else SF_DIR
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    found = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())

    cursor = duck[folder].execute(ORACLE[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    order = list(described)
    expected = sorted(
        repr(tuple(row[order.index(c)] for c in columns)) for row in cursor.fetchall()
    )
    kinds = {c: SPARK_TYPES.get(k, k.lower()) for c, k in described.items()}
    assert {f.name: f.dataType.simpleString() for f in df.schema} == kinds
    assert found == expected


@pytest.mark.parametrize("name", LOADS[:2])
def test_load_refuses_repeated_keys(spark, name):
    with pytest.raises(RuleViolation, match="shipment_id has repeated values"):
        QUERIES[name](spark, SF_DIR)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).collect()


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
