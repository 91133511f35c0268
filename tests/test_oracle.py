"""Every query against its SQL statement on the benchmark tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from compare import BASE_TABLES, connect, differences
from pyspark.sql import functions as F

from cohortline.plans.catalog import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
STATEMENTS = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_query(spark, db, name):
    result = entry.queries()[name](spark, SF_DIR)
    assert differences(result, db, STATEMENTS[name]) == []


SKEW_CHECKED = [
    "stg_trials",
    "stg_trial_conditions",
    "stg_approvals",
    "dim_sponsor",
    "fct_trials",
    "metric_phase_transition",
    "metric_sponsor_cohorts",
    "metric_duration_trends_by_phase",
    "termination_rate_by_sponsor_class",
    "top_sponsors_by_approval_count",
    "export_phase_funnel",
    "export_termination_reasons",
    "join_inner_multi",
    "win_partition_sum",
    "league_ranked",
    "dq_relationships",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Tables in which one customer, part and supplier each hold a third of their rows."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    source = "/root/testdata/sf0.001"

    def put(frame, name):
        frame.coalesce(1).write.parquet(f"{folder}/{name}.parquet")

    def mostly(column, key, row_key):
        hot = F.pmod(F.xxhash64(row_key), F.lit(3)) == 0
        return F.when(hot, F.lit(key).cast("bigint")).otherwise(F.col(column)).alias(column)

    for name in BASE_TABLES:
        frame = spark.read.parquet(f"{source}/{name}.parquet")
        if name == "orders":
            frame = frame.withColumn("o_custkey", mostly("o_custkey", 7, "o_orderkey"))
        if name == "lineitem":
            frame = frame.withColumn("l_partkey", mostly("l_partkey", 3, "l_extendedprice"))
            frame = frame.withColumn("l_suppkey", mostly("l_suppkey", 5, "l_tax"))
        put(frame, name)
    return folder


def test_skewed_tables_beyond_the_broadcast_bound(spark, skewed):
    db = connect(skewed, "*.parquet")
    bound = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(bound)
    spark.conf.set(bound, "-1")
    try:
        found = {
            name: differences(entry.queries()[name](spark, skewed), db, STATEMENTS[name]) for name in SKEW_CHECKED
        }
    finally:
        spark.conf.set(bound, before)
    assert found == {name: [] for name in SKEW_CHECKED}


def test_flagship_runs(spark):
    assert entry.entry(spark).columns == ["sponsor_class", "trial_count", "terminated_count", "termination_rate"]
