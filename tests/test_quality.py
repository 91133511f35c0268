from __future__ import annotations

import datetime
import json

import pytest
from registry import application, rows, study, submission
from pyspark.sql import functions as F

from cohortline.__main__ import main
from cohortline.plans import quality
from cohortline.refresh import refresh
from cohortline.streaming.ingest import land


def tables_of(**frames):
    return frames.__getitem__


def test_rule_counts():
    assert sum(map(len, quality.NOT_NULL.values())) == 64
    assert sum(map(len, quality.UNIQUE.values())) == 18
    assert sum(map(len, quality.ACCEPTED.values())) == 10
    assert len(quality.RELATIONSHIPS) == 10


def test_each_kind_finds_its_violation(spark):
    child = spark.createDataFrame(
        [("a", "x"), ("a", "y"), (None, "x"), ("b", None), ("c", "x"), ("c", "x")], "k string, v string"
    )
    tables = tables_of(child=child, parent=spark.createDataFrame([("a",)], "k string"))
    found = [
        *rows(quality.not_null(tables, {"child": ["k", "v"]})),
        *rows(quality.unique(tables, {"child": ["k"]})),
        *rows(quality.accepted_values(tables, {"child": {"v": ["x"]}})),
        *rows(quality.relationships(tables, [("child", "k", "parent", "k")])),
    ]
    assert found == [
        ("child", "k", "not_null", 1),
        ("child", "v", "not_null", 1),
        ("child", "k", "unique", 2),
        ("child", "v", "accepted_values", 1),
        ("child", "k", "relationships", 3),
    ]
    with pytest.raises(quality.QualityError, match="child.k"):
        quality.require_clean(quality.unique(tables, {"child": ["k"]}))


def test_uniqueness_of_all_tables_takes_one_scan_each_and_one_exchange(spark):
    first = spark.range(20).select("id", (F.col("id") % 3).alias("three"), F.lit(None).cast("date").alias("none"))
    second = spark.createDataFrame([("1",), ("2",), ("2",), (None,), (None,)], "id string")
    rules = {"first": ["id", "three", "none"], "second": ["id"]}
    found = quality.unique(tables_of(first=first, second=second), rules)
    assert rows(found, "model", "column_name", "failures") == [
        ("first", "id", 0),
        ("first", "none", 0),
        ("first", "three", 3),
        ("second", "id", 1),
    ]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Range (") == 1
    planned = found._jdf.queryExecution().executedPlan().toString()
    assert planned.count("Exchange hashpartitioning") == 1


def test_rules_hold_on_empty_tables(make_warehouse):
    report = quality.report(make_warehouse().table)
    assert report.count() == 102
    assert report.where("failures > 0").isEmpty()


def test_gate_and_freshness(spark, make_warehouse):
    w = make_warehouse([study("A")])
    assert rows(quality.nonempty(w.table)) == [("raw_applications", False), ("raw_studies", True)]
    with pytest.raises(quality.QualityError, match="raw_applications"):
        quality.require_nonempty(w.table)
    newest = F.lit("2020-01-01 00:00:00").cast("timestamp")
    w._tables["raw_studies"] = w.raw_studies.withColumn("fetched_at", newest)
    ages = {26: "pass", 27: "warn", 50: "warn", 51: "error"}
    for hours, status in ages.items():
        as_of = newest + F.expr(f"interval {hours} hours")
        assert rows(quality.freshness(w.table, as_of), "source", "status") == [
            ("raw_applications", "error"),
            ("raw_studies", status),
        ]


GOOD_STUDIES = [
    study(
        f"N{i}",
        status="COMPLETED",
        sponsor="Acme",
        start="2000-01",
        end="2001-01",
        phases=["PHASE2"],
        conditions=["Flu"],
        interventions=[{"name": "X", "type": "DRUG"}],
        results=True,
    )
    for i in range(3)
]
APPLICATIONS = [application("1", "acme", [submission()]), application("2", "x", []), application("3", "x")]


def test_refresh_publishes_and_exports(spark, make_warehouse, tmp_path):
    raw = make_warehouse(GOOD_STUDIES, APPLICATIONS)
    for run in (1, 2):
        refresh(raw.raw_studies, raw.raw_applications, str(tmp_path / "out"))
        log = spark.read.parquet(str(tmp_path / "out" / "ops" / "extraction_log"))
        assert rows(log, "model_name", "excluded_count") == [("stg_approvals", 2)] * run
    assert spark.table("marts.fct_trials").count() == 3
    assert spark.sql("select count(*) from metrics.metric_phase_transition where has_fda_approval").first()[0] == 3
    assert spark.table("stg_trial_conditions").count() == 3
    assert spark.newSession().sql("select count(*) from staging.stg_trials").first()[0] == 3
    exported = spark.read.option("header", True).csv(str(tmp_path / "out" / "exports" / "phase_funnel"))
    assert rows(exported, "condition_name", "phase2_trials", "approved_trials") == [("Flu", "3", "3")]
    assert len(list((tmp_path / "out" / "exports").iterdir())) == 8


def test_jobs_from_landed_pages_to_tables(spark, tmp_path):
    """Both sources landed, ingested and built by way of the command line."""

    def documents(rows_of_source):
        return [json.loads(payload) for _, payload in rows_of_source]

    listed = {"studies": {"studies": documents(GOOD_STUDIES)}, "applications": {"results": documents(APPLICATIONS)}}
    for source, body in listed.items():
        at = {name: str(tmp_path / source / name) for name in ("landing", "log", "checkpoint")}
        page = [(0, datetime.datetime(2024, 1, 1), json.dumps(body))]
        land(spark.createDataFrame(page, "page bigint, fetched_at timestamp, body string"), at["landing"])
        main(["ingest", "--source", source, *(part for name, path in at.items() for part in (f"--{name}", path))])
    logs = [f"--{source}-log={tmp_path / source / 'log'}" for source in listed]
    main(["refresh", *logs, f"--target={tmp_path / 'target'}"])
    trials = spark.table("marts.fct_trials")
    assert rows(trials, "nct_id") == [("N0",), ("N1",), ("N2",)]


STAGING = ("stg_trials", "stg_sponsors", "stg_trial_conditions", "stg_trial_interventions", "stg_approvals")


def test_persisted_staging_equals_the_models(spark, make_warehouse, tmp_path):
    raw = make_warehouse(GOOD_STUDIES, APPLICATIONS)
    w = refresh(raw.raw_studies, raw.raw_applications, str(tmp_path / "out"))
    for name in STAGING:
        stored = spark.table(f"staging.{name}")
        assert stored.columns == w.table(name).columns
        assert rows(stored) == rows(w.table(name))


def test_a_broken_run_leaves_what_is_published(spark, make_warehouse, tmp_path):
    """A second run breaks a rule: tables and exports stay, and dependents are not built."""
    out = tmp_path / "out"
    good = make_warehouse(GOOD_STUDIES, APPLICATIONS)
    refresh(good.raw_studies, good.raw_applications, str(out))
    names = [row.tableName for row in spark.sql("show tables in marts").where("not isTemporary").collect()]
    before = {name: rows(spark.table(f"marts.{name}")) for name in names}
    exported = sorted((path.name, path.stat().st_mtime_ns) for path in (out / "exports").rglob("part-*"))
    bad = make_warehouse([*GOOD_STUDIES, study("N9", status="MYSTERY", sponsor="New", results=True)], APPLICATIONS)
    with pytest.raises(quality.QualityError, match="stg_trials.overall_status"):
        refresh(bad.raw_studies, bad.raw_applications, str(out))
    assert {name: rows(spark.table(f"marts.{name}")) for name in names} == before
    assert sorted((path.name, path.stat().st_mtime_ns) for path in (out / "exports").rglob("part-*")) == exported
    newest = sorted((out / "runs").iterdir())[-1]
    built = {path.name for layer in ("marts", "metrics") for path in (newest / layer).glob("*")}
    assert "fct_trials" not in built and "dim_sponsor" not in built and "fct_approvals" in built


def test_a_partial_run_publishes_the_other_branches(spark, make_warehouse, tmp_path):
    good = make_warehouse(GOOD_STUDIES, APPLICATIONS)
    refresh(good.raw_studies, good.raw_applications, str(tmp_path / "out"))
    bad_studies = [*GOOD_STUDIES, study("N9", status="MYSTERY", results=True)]
    bad = make_warehouse(bad_studies, [*APPLICATIONS, application("7", "new", [submission()])])
    with pytest.raises(quality.QualityError):
        refresh(bad.raw_studies, bad.raw_applications, str(tmp_path / "out"), partial=True)
    assert rows(spark.table("marts.fct_approvals"), "application_number") == [("1",), ("7",)]
    assert spark.table("marts.fct_trials").count() == 3


def test_input_below_the_target_and_old_runs(spark, make_warehouse, tmp_path):
    out = str(tmp_path / "out")
    raw = make_warehouse(GOOD_STUDIES, APPLICATIONS)
    w = refresh(raw.raw_studies, raw.raw_applications, out)
    for _ in range(2):
        w = refresh(w.raw_studies, w.raw_applications, out, keep_runs=2)
    assert spark.table("marts.fct_trials").count() == 3
    assert len(list((tmp_path / "out" / "runs").iterdir())) == 2


def test_unreadable_documents_are_counted_and_left_out(spark, make_warehouse, tmp_path):
    bad = [("B1", '{"protocolSection": {'), ("B2", "[]"), ("B3", None)]
    raw = make_warehouse([*GOOD_STUDIES, *bad], APPLICATIONS)
    refresh(raw.raw_studies, raw.raw_applications, str(tmp_path / "out"), strict=False)
    assert rows(spark.table("staging.stg_trials"), "nct_id") == [("N0",), ("N1",), ("N2",)]
    log = spark.read.parquet(str(tmp_path / "out" / "ops" / "extraction_log"))
    assert rows(log, "model_name", "excluded_count") == [("stg_approvals", 2), ("stg_trials", 3)]
