"""Every named query against its DuckDB twin, and the shape of the plans."""

from __future__ import annotations

import re

import pytest
from compare import assert_same, duck

import __spark_entry__ as driver
from terrace.plans import checks
from terrace.plans.queries import QUERIES, warehouse
from terrace.sources import testdata

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_twin(spark, connection, name):
    assert assert_same(QUERIES[name](spark, SF_DIR), connection, driver.oracle_sql()[name]) > 0


def test_entry(spark):
    found = driver.entry(spark)
    assert found.columns[:2] == ["order_id", "customer_key"] and found.count() == 1500


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("bronze", "pipeline"))])
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert bad not in text, f"{name} uses {bad}"


def test_scans_read_only_the_columns_they_need(spark):
    text = plan(QUERIES["silver_order_items"](spark, SF_DIR))
    (columns,) = re.findall(r"FileScan parquet \[([^]]*)\]", text)
    assert {c.partition("#")[0] for c in columns.split(",")} == {
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_tax", "l_shipdate",
    }
    house = warehouse(spark, SF_DIR)
    text = plan(QUERIES["late_rate_by_region"](spark, SF_DIR))
    assert "price" not in text and house["fact_orders"] is house["fact_orders"]


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["silver_order_payments"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in text


def test_raw_suite_scans_once_per_rule_group(spark):
    raw = testdata.raw_tables(spark, SF_DIR)
    one = checks.raw_results({name: raw[name] for name in checks.RAW_SUITES})
    # Four tables, each scanned for its row rules and again for its key rule; the
    # customers view adds nation and region to both of its scans.
    assert plan(one).count("FileScan parquet") == 4 * 2 + 2 * 2


def test_geolocation_pre_aggregates_before_both_shuffles(spark):
    text = plan(QUERIES["silver_geolocation"](spark, SF_DIR))
    parts = text.split("Exchange hashpartitioning")
    assert len(parts) == 3 and all("partial_" in part for part in parts[1:])
