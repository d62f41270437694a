"""Queries on tables in which one key holds a third of the rows.

Joins shuffle and adaptive execution splits partitions, as it would at scale.
"""

import duckdb
import pytest

from test_oracles import ORACLES, QUERIES, TABLES, order_key

SKEWED = {
    "orders": """
SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE o_custkey END AS o_custkey,
                  CASE WHEN o_orderkey = 6 THEN 'F' ELSE o_orderstatus END AS o_orderstatus)
FROM '{source}/orders.parquet'""",
    # A third of the items belong to one order; half of those are copies of one row.
    "lineitem": """
SELECT * EXCLUDE (rn) REPLACE (
  CASE WHEN rn % 3 = 0 THEN 6 ELSE l_orderkey END AS l_orderkey,
  CAST(CASE WHEN rn % 6 = 0 THEN rn WHEN rn % 3 = 0 THEN 1 ELSE l_linenumber END AS INTEGER)
    AS l_linenumber,
  CASE WHEN rn % 3 = 0 THEN 8 ELSE l_partkey END AS l_partkey,
  CASE WHEN rn % 3 = 0 THEN 5 ELSE l_suppkey END AS l_suppkey,
  CASE WHEN rn % 3 = 0 THEN 10.0 ELSE l_quantity END AS l_quantity,
  CASE WHEN rn % 3 = 0 THEN 77.5 ELSE l_extendedprice END AS l_extendedprice,
  CASE WHEN rn % 3 = 0 THEN TIMESTAMP '1999-01-01' ELSE l_shipdate END AS l_shipdate)
FROM (SELECT *, row_number() OVER () AS rn FROM '{source}/lineitem.parquet')""",
}


@pytest.fixture(scope="module")
def skewed(sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        rows = SKEWED.get(name, "SELECT * FROM '{source}/" + name + ".parquet'")
        con.execute(f"COPY ({rows.format(source=sf_dir)}) TO '{folder}/{name}.parquet'")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), con


@pytest.mark.parametrize(
    "name",
    [
        "clean_orders",
        "accepted_items",
        "quarantined_items",
        "quarantine_exact",
        "dim_customers",
        "fact_order_items",
        "monthly_trend",
        "revenue_by_state",
        "delivery_performance",
        "top_products",
        "top_categories",
        "dq_orphans",
        "dq_reconciliation_exact",
        "dq_suite_silver",
    ],
)
def test_query(spark, skewed, settings, name):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
    )
    folder, con = skewed
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    theirs = con.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(order_key, df.select(*columns).collect())) == sorted(map(order_key, theirs))
