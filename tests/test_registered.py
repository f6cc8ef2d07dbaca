"""Every registered query beside its SQL on the smallest stored data set."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from depotflow.plans.catalogue import NAMES
from depotflow.sources import schema, star as model
from tests.compare import compare, oracle

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="stored tables are not here")


@pytest.fixture(scope="module")
def connection():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, connection, name):
    assert compare(spark, connection, entry.queries()[name], entry.oracle_sql().get(name), FOLDER) is None


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["anr", "aname"] and found.count() > 0


def test_no_query_multiplies_or_leaves_the_engine(spark):
    """No plan without broadcasts builds all pairs, loops over rows in Python, or cuts rows."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in NAMES:
            if name in ("d9_stock_stream", "d9_stream_rejects"):
                continue
            plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
            for word in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "CollectLimit"):
                assert word not in plan, (name, word)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name,parts", [
    ("e4_2_parts_of_busy_suppliers", ["GreaterThanOrEqual(l_shipdate,1998-08-01T00:00)"]),
    ("q4_table_function", ["GreaterThanOrEqual(l_shipdate,2000-01-01T00:00)"]),
    ("e5_24_city_delivery_count", ["ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>"]),
    ("a4_group_by_key", ["ReadSchema: struct<l_suppkey:bigint,l_quantity:double>"]),
    ("d5_delete", ["ReadSchema: struct<s_suppkey:bigint,s_name:string,s_nationkey:int,s_acctbal:double>"]),
])
def test_filters_and_columns_reach_the_scan(spark, name, parts):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for part in parts:
        assert part in plan


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_declared_schemas_are_the_stored_ones(spark, scale):
    folder = Path(FOLDER).with_name(scale)
    for name in schema.STORED:
        found = spark.read.parquet(f"{folder}/{name}.parquet").schema
        assert model.stored(spark, folder, name).schema == found, name
