"""Every registered query against its DuckDB statement."""

import importlib.util
import os

import duckdb
import pytest

from tierline_queries import oracle, registry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
spec = importlib.util.spec_from_file_location("spark_entry", f"{ROOT}/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

QUERIES, ORACLES = registry.queries(), oracle.statements()
TABLES = "region nation customer supplier part orders lineitem".split()
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def order_key(row):
    return tuple((v is not None, str(v)) for v in row)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    wanted = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(wanted.columns)
    duck_types = dict(zip(wanted.columns, map(str, wanted.types)))
    for column, kind in df.dtypes:
        assert TYPES.get(kind, kind.upper()) == duck_types[column], column
    at = [wanted.columns.index(c) for c in columns]
    theirs = [tuple(row[i] for i in at) for row in wanted.fetchall()]
    ours = [tuple(row[c] for c in columns) for row in df.collect()]
    assert ours, "a query that returns nothing checks nothing"
    assert sorted(ours, key=order_key) == sorted(theirs, key=order_key)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
