"""Registered queries: agreement with their SQL twins, and the shape of their plans."""

import os
import re

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from claimweave.operators import gold
from claimweave.plans import oracle, registry

SF_DIR = os.environ.get("CLAIMWEAVE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registry.queries(), oracle.oracle_sql()


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def twin():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_a_fact_load_shuffles_claims_by_their_id_once(spark):
    """Silver that one plan reads once is not stored, and its claims stay where the cleansing dealt them."""
    lake = registry.Lake(spark, SF_DIR)
    loaded = lake.first_fact()._jdf.queryExecution().executedPlan().toString()
    assert not [name for name in lake._tables if name.startswith("silver")]
    dealt = re.findall(r"Exchange hashpartitioning\(claim_id#", loaded)
    assert len(dealt) == 1, dealt
    stored = lake.silver
    assert lake.claims_once() is stored


def test_lookups_run_nothing_while_planned(spark):
    """Building a query that only joins and aggregates starts no job."""
    lake = registry.Lake(spark, SF_DIR)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tracker = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("planning", "lookups")
        claims = lake.cleansed()[0]
        gold.provider_kpi(gold.enrich_claims(claims, lake.patients_after(1), lake.providers_after(1)))
        jobs = tracker.getJobIdsForGroup("planning")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sparkContext.setJobGroup("other", "other")
    # a schema is read from a file's footer, one small job for each spark.read; nothing else runs
    assert all(len(tracker.getJobInfo(j).stageIds) == 1 for j in jobs) and len(jobs) <= 12


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, twin, name):
    assert compare(spark, twin, SF_DIR, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", ["provider_kpi", "fact_delete_insert", "scd2_patient", "ops_metrics"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(spark, name)
    for operator in ("PythonUDF", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_dedup_prunes_before_the_shuffle(spark):
    text = plan(spark, "claims_latest")
    partial = text.index("Partial")
    assert "WindowGroupLimit" in text[partial - 2000 : partial + 10]
    assert text.index("Final") < text.index("Exchange hashpartitioning(claim_id") < partial


def test_dimension_lookups_do_not_shuffle_claims(spark):
    text = plan(spark, "gold_fact")
    assert text.count("BroadcastHashJoin") >= 2
    assert not re.search(r"hashpartitioning\((member_id|provider_id)", text)


def test_scan_reads_needed_columns_only(spark):
    text = plan(spark, "risk_tier_counts")
    scan = re.search(r"FileScan parquet \[(l_[^\]]*)\]", text).group(1)
    assert "l_returnflag" not in scan and "l_shipdate" not in scan


def test_entry_runs(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("the given tables are not here")
    assert entry.entry(spark).count() > 0


def test_lines_are_hashed_to_their_orders_without_a_sort(spark):
    found = plan(spark, "claims_coerce_normalize")
    assert "ShuffledHashJoin" in found and "SortMergeJoin" not in found


@pytest.mark.parametrize("name", ["expected_claims", "quarantine_replay", "ops_metrics"])
def test_queries_that_read_bronze_several_times_join_the_feed_once(spark, name):
    lake = registry.Lake(spark, SF_DIR)
    registry.CATALOGUE[name](lake)
    assert "lineitem" not in lake.bronze._jdf.queryExecution().executedPlan().toString()


def test_reconcile_stored_joins_the_feed_once(spark):
    lake = registry.Lake(spark, SF_DIR)
    registry.CATALOGUE["reconcile_stored"](lake)
    assert "lineitem" not in lake.bronze._jdf.queryExecution().executedPlan().toString()


def test_bronze_writes_each_day_out_once(spark):
    found = plan(spark, "incremental_since_watermark"), registry.Lake(spark, SF_DIR).bronze
    whole = found[1]._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"cast\(cast\(\w+#\d+ as date\) as string\)", whole)) == 2
    assert "as date) as string)" not in found[0]
