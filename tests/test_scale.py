"""Properties that matter on a cluster: shuffles, hot keys, pushdown, driver traffic."""

from __future__ import annotations

import re

import pytest
from registry import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cohortline.operators import latest_by_key, lookup, number_rows
from cohortline.plans import marts
from cohortline.plans.catalog import QUERIES
from cohortline.plans.staging import stg_approvals
from cohortline.sources import benchmark_tables
from cohortline.sources.benchmark_tables import study_key
from cohortline.sources.documents import parse_applications, study_columns
from cohortline.warehouse import RAW
from cohortline.workspace import shared_folder

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def warehouse(spark):
    return entry.warehouse(spark, SF_DIR)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def setting(spark):
    """Change session settings for one test."""
    saved = {}

    def change(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield change
    for key, value in saved.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize(
    "name",
    [
        "stg_trials",
        "stg_trial_conditions",
        "stg_trial_interventions",
        "stg_approvals",
        "bridge_trial_condition",
        "bridge_trial_intervention",
        "fct_trials",
        "fct_approvals",
        "application_status",
        "studies_parsed",
        "applications_parsed",
    ],
)
def test_row_local_models_do_not_shuffle(warehouse, name):
    assert "Exchange" not in plan(warehouse.plan(name))


@pytest.mark.parametrize("name", ["studies_parsed", "applications_parsed"])
def test_a_document_is_parsed_once(warehouse, name):
    text = plan(warehouse.plan(name))
    assert text.count("parseJson(") == 1 and "from_json(" not in text


def test_no_query_has_a_cross_join_or_python_in_its_plan(spark):
    for name in QUERIES:
        text = plan(entry.queries()[name](spark, SF_DIR))
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert operator not in text, f"{operator} in {name}"


def test_scans_read_only_what_is_asked(warehouse):
    text = plan(entry.queries()["filt_bool"](warehouse.spark, SF_DIR))
    assert re.search(r"ReadSchema: struct<nct_id:string,is_terminated:boolean,why_stopped:string>", text)
    assert "PushedFilters: [IsNotNull(is_terminated), EqualTo(is_terminated,true)]" in text


def test_small_lookups_leave_the_fact_unshuffled(warehouse):
    for name in ("trial_funnel", "metric_phase_transition"):
        text = plan(warehouse.plan(name))
        assert text.count("BroadcastHashJoin") == 1 and "Exchange hashpartitioning" not in text


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_beyond_the_broadcast_bound(spark, tmp_path, setting, how):
    """A hot key, NULLs and rare keys: one scan and one shuffle of the fact, hot partitions split."""
    keys = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 997))
    spark.range(300_000).select("id", keys.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("c")).write.parquet(
        str(tmp_path / "fact")
    )
    fact = spark.read.parquet(str(tmp_path / "fact"))
    dimension = spark.createDataFrame([(k, f"v{k}") for k in ("hot", *(f"k{i}" for i in range(0, 997, 2)))], "k string, v string")
    expected = fact.join(F.broadcast(dimension), "k", how).agg(F.count(F.lit(1)), F.sum(F.xxhash64("id", "v") % 1000)).first()
    setting(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="200k",
        adaptive__advisoryPartitionSizeInBytes="100k",
        adaptive__skewJoin__skewedPartitionFactor="2",
        shuffle__partitions="16",
    )
    joined = lookup(fact, dimension, "k", how)
    text = plan(joined)
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 2
    counted = joined.agg(F.count(F.lit(1)), F.sum(F.xxhash64("id", "v") % 1000))
    assert counted.collect()[0] == expected
    assert "skew=true" in plan(counted)


def test_models_are_the_same_beyond_the_broadcast_bound(warehouse, setting):
    names = ("raw_studies", "raw_applications", "trial_funnel", "metric_phase_transition", "metric_sponsor_cohorts")

    def build():
        plans = {name: warehouse.plan(name) for name in names if name not in RAW}
        plans["raw_studies"] = benchmark_tables.raw_studies(warehouse.spark, SF_DIR)
        plans["raw_applications"] = benchmark_tables.raw_applications(warehouse.spark, SF_DIR)
        return {name: rows(frame) for name, frame in plans.items()}

    expected = build()
    setting(autoBroadcastJoinThreshold="-1")
    assert build() == expected


def test_the_phase_metric_reads_its_trials_once_beyond_the_bound(warehouse, setting):
    setting(autoBroadcastJoinThreshold="-1")
    text = plan(warehouse.plan("metric_phase_transition"))
    assert text.count("FileScan") == 2 and text.count("Exchange") == 2


def test_hot_key_is_reduced_before_the_shuffle(spark):
    records = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("fetched_at"),
        F.lit(0).alias("page"),
        F.lit(0).alias("pos"),
    )
    latest = latest_by_key(records, "k")
    assert latest.where("k = 'hot'").first().fetched_at == 29997
    text = plan(latest)
    assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", text)


def test_number_rows_equals_a_global_window(spark, workspace):
    frame = spark.range(5000).select((F.col("id") % 7).alias("n"), F.col("id").cast("string").alias("name"))
    order = F.col("n").desc(), F.col("name").asc()
    numbered = number_rows(frame, "rank", workspace, *order)
    expected = frame.select(F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("rank"), "n", "name")
    assert rows(numbered) == rows(expected)


def test_long_keys_keep_their_digits(spark):
    keys = spark.createDataFrame([(7,), (123456789,), (123456780,)], "k bigint").select(study_key(F.col("k")))
    assert [r[0] for r in keys.collect()] == ["NCT00000007", "NCT123456789", "NCT123456780"]


def _with_hot_lines(spark, folder: str, **hot: int) -> None:
    """The smallest tables with a quarter of the line items twice more, all of one key."""
    for name in ("orders", "customer", "part", "supplier"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    more = lines.withColumns({name: F.lit(value).cast("bigint") for name, value in hot.items()})
    lines.unionByName(more).unionByName(more).write.parquet(f"{folder}/lineitem.parquet")


def test_a_hot_order_makes_many_studies_and_loses_nothing(spark, tmp_path):
    folder = str(tmp_path)
    _with_hot_lines(spark, folder, l_orderkey=1)
    raw = benchmark_tables.raw_studies(spark, folder)
    assert raw.agg(F.max(F.length("payload"))).first()[0] < 250_000
    assert raw.count() == raw.select("nct_id").distinct().count() > spark.read.parquet(f"{folder}/orders.parquet").count()
    assert_lossless(spark, folder)


def test_a_hot_pair_makes_many_applications_and_loses_nothing(spark, tmp_path):
    folder = str(tmp_path)
    _with_hot_lines(spark, folder, l_suppkey=3, l_partkey=5)
    raw = benchmark_tables.raw_applications(spark, folder)
    assert raw.agg(F.max(F.length("payload"))).first()[0] < 500_000
    assert_lossless(spark, folder)


def assert_lossless(spark, folder: str) -> None:
    """Outcomes and submissions are the line items, sites the orders' suppliers."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    studies = study_columns(benchmark_tables.raw_studies(spark, folder), "num_primary_outcomes", "num_sites")
    outcomes, sites = studies.agg(F.sum("num_primary_outcomes"), F.sum("num_sites")).first()
    listed = spark.read.parquet(f"{folder}/orders.parquet").where("o_orderkey % 10 <> 0").select("o_orderkey")
    known = lines.join(spark.read.parquet(f"{folder}/orders.parquet"), F.col("o_orderkey") == F.col("l_orderkey"))
    shown = lines.join(listed, F.col("o_orderkey") == F.col("l_orderkey"))
    assert outcomes == known.count()
    assert sites == shown.select("l_orderkey", "l_suppkey").distinct().count()
    approvals = stg_approvals(parse_applications(benchmark_tables.raw_applications(spark, folder)))
    assert approvals.count() == lines.count()


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01", "sf0.1"])
def test_documents_keep_every_line_item(spark, size):
    assert_lossless(spark, f"/root/testdata/{size}")


@pytest.mark.parametrize(
    "name, paths",
    [
        ("proj_json_path", {"briefTitle", "overallStatus"}),
        ("fn_array_length", {"primaryOutcomes", "locations"}),
        ("fn_array_join_nullif", {"phases"}),
        ("fn_partial_date", {"startDateStruct", "completionDateStruct"}),
    ],
)
def test_the_parser_is_given_only_the_paths_asked_for(warehouse, name, paths):
    text = entry.queries()[name](warehouse.spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    read = set(re.findall(r"StructField\((\w+),", text))
    assert paths <= read and not {"conditions", "interventions", "leadSponsor", "enrollmentInfo"} & read


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_facts_equal_their_joined_form(warehouse):
    joined = warehouse.stg_trials.join(
        marts.dim_sponsor(warehouse.stg_trials).select("sponsor_name", "sponsor_key"), "sponsor_name", "left"
    )
    assert rows(joined, "nct_id", "sponsor_key") == rows(warehouse.fct_trials, "nct_id", "sponsor_key")
