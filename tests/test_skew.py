"""All queries on skewed tables, with every join taking the path for large inputs.

A third of the rows of each big table share one order, customer, product, seller,
zip or person; keys are missing here and there. Broadcasts by size are off and
the hot-key limit is low, so all lookups shuffle and salt.
"""

from __future__ import annotations

import pytest
from compare import assert_same, duck

import __spark_entry__ as driver
from terrace.operators import joins
from terrace.plans.queries import QUERIES

SOURCE = "/root/testdata/sf0.001"

# What the driver's tables would look like with one dominant key each.
SKEWED = {
    "customer": "select c_custkey, c_name, case when c_custkey % 3 = 0 then 7 else c_nationkey end as c_nationkey, "
                "c_acctbal, c_mktsegment from source",
    "orders": "select o_orderkey, case when o_orderkey % 3 = 0 then 5 when o_orderkey % 101 = 0 then null "
              "else o_custkey end as o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from source",
    "lineitem": "select case when l_extendedprice % 3 < 1 then 42 else l_orderkey end as l_orderkey, "
                "case when l_extendedprice % 5 < 2 then 3 when l_partkey % 17 = 0 then null else l_partkey end "
                "as l_partkey, case when l_extendedprice % 7 < 3 then 1 else l_suppkey end as l_suppkey, "
                "l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate "
                "from source",
    "part": "select p_partkey, p_name, p_brand, case when p_partkey % 3 = 0 then 'SMALL' else p_type end as p_type, "
            "p_size, p_retailprice from source",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    source = duck(SOURCE)
    for (table,) in source.execute("select view_name from duckdb_views() where not internal").fetchall():
        sql = SKEWED.get(table, "select * from source").replace("source", table)
        source.execute(f"copy ({sql}) to '{folder}/{table}.parquet' (format parquet)")
    return str(folder), duck(str(folder))


@pytest.fixture(scope="module")
def large_inputs(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    limit = joins.ROWS_PER_TASK
    joins.ROWS_PER_TASK = 50
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    joins.ROWS_PER_TASK = limit
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("bronze", "pipeline", "staging"))])
def test_query_on_skewed_tables(spark, skewed, large_inputs, name):
    folder, connection = skewed
    assert_same(QUERIES[name](spark, folder), connection, driver.oracle_sql()[name])
