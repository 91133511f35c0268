from __future__ import annotations

import datetime

import pytest
from registry import application, rows, study, submission
from pyspark.errors import PySparkException

from cohortline.plans.metrics import application_status
from cohortline.sources.documents import parse_applications, parse_studies, unreadable

D = datetime.date


def test_study_fields(make_warehouse):
    w = make_warehouse(
        [
            study(
                "NCT1",
                title="",
                status="COMPLETED",
                start="2020-07",
                end="2021-07-15",
                why="",
                phases=["PHASE1", "PHASE2"],
                enrollment=40,
                sponsor="Acme",
                sponsor_class="INDUSTRY",
                outcomes=[{}],
                locations=[{}, {"facility": "x"}],
                results=False,
            )
        ]
    )
    assert tuple(w.stg_trials.drop("source_fetched_at").first()) == (
        "NCT1",
        "",  # titles are not blanked
        "COMPLETED",
        "PHASE1|PHASE2",
        40,
        D(2020, 7, 1),
        D(2021, 7, 15),
        "Acme",
        "INDUSTRY",
        None,
        False,
        1,
        2,
    )


def test_absent_fields_are_null(make_warehouse):
    w = make_warehouse([study("NCT1"), ("NCT2", "{}")])
    for row in w.stg_trials.drop("source_fetched_at", "nct_id").collect():
        assert all(value is None for value in row)
    assert w.stg_trial_conditions.isEmpty() and w.stg_trial_interventions.isEmpty()


def test_array_lengths(make_warehouse):
    w = make_warehouse([study("A"), study("B", outcomes=[], locations=[]), study("C", outcomes=[{}, {}])])
    lengths = rows(w.stg_trials, "nct_id", "num_primary_outcomes", "num_sites")
    assert lengths == [("A", None, None), ("B", 0, 0), ("C", 2, None)]


def test_phases(make_warehouse):
    w = make_warehouse([study("A", phases=["PHASE1"]), study("B", phases=[]), study("C")])
    assert rows(w.stg_trials, "nct_id", "phase") == [("A", "PHASE1"), ("B", None), ("C", None)]


def test_numbers_in_quotes_are_read_and_bad_ones_raise(make_warehouse):
    w = make_warehouse([study("A", enrollment="40", results="true")])
    assert rows(w.stg_trials, "enrollment_count", "has_results") == [(40, True)]
    with pytest.raises(PySparkException):
        make_warehouse([study("A", enrollment="many")]).stg_trials.collect()


def test_conditions_are_trimmed_and_distinct(make_warehouse):
    w = make_warehouse(
        [study("A", conditions=["Asthma", " Asthma ", "", "  ", "Flu"]), study("B", conditions=[]), study("C")]
    )
    assert rows(w.stg_trial_conditions) == [("A", "Asthma"), ("A", "Flu")]


def test_interventions_keep_types_apart(make_warehouse):
    w = make_warehouse(
        [
            study(
                "A",
                interventions=[
                    {"name": "X", "type": "DRUG"},
                    {"name": " X ", "type": "DRUG"},
                    {"name": "X", "type": "DEVICE"},
                    {"name": " ", "type": "DRUG"},
                    {"type": "DRUG"},
                    {"name": "Y"},
                ],
            )
        ]
    )
    assert rows(w.stg_trial_interventions) == [("A", "X", "DEVICE"), ("A", "X", "DRUG"), ("A", "Y", None)]
    # The bridge takes an inner join on both columns, which a missing type cannot match.
    assert w.dim_intervention.count() == 3
    assert w.bridge_trial_intervention.count() == 2


def test_submissions(make_warehouse):
    w = make_warehouse(
        applications=[
            application("N1", " acme ", [submission(), submission("SUPPL", priority="")]),
            application("N2", "", [submission(status="", date="2020-01-31", priority=None)]),
            application("N3", "x", []),
            application("N4", "x"),
        ]
    )
    assert rows(w.stg_approvals.drop("approval_key", "source_fetched_at")) == [
        ("N1", " acme ", "ORIG", "1", "AP", D(2020, 1, 31), "STANDARD"),
        ("N1", " acme ", "SUPPL", "1", "AP", D(2020, 1, 31), None),
        ("N2", None, "ORIG", "1", None, None, None),
    ]
    assert w.stg_approvals.select("approval_key").distinct().count() == 3


def test_a_payload_is_parsed_once(make_warehouse):
    w = make_warehouse([study("A")], [application("N1", "x", [submission()])])
    for frame in (parse_studies(w.raw_studies), parse_applications(w.raw_applications)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("parseJson(") == 1 and "from_json" not in plan


def test_what_can_be_read(make_warehouse):
    """A field of a wrong type is null; what is not one whole object is set aside."""
    payloads = {
        "A": '{"protocolSection": {"designModule": {"phases": "PHASE1"}, "statusModule": {"overallStatus": "COMPLETED"}}}',
        "B": '  {"protocolSection": {"statusModule": {"whyStopped": 12}}}',
        "C": '{"protocolSection": {"conditionsModule": {"conditions": ["Flu", 7, null]}}}',
        "D": '{"protocolSection": null}',
        "E": '{"protocolSection": {',
        "F": "[1]",
        "G": "",
        "H": None,
        "I": '{"hasResults": true, "hasResults": false}',
    }
    w = make_warehouse(list(payloads.items()))
    assert rows(w.stg_trials, "nct_id", "overall_status", "phase", "why_stopped") == [
        ("A", "COMPLETED", None, None), ("B", None, None, "12"), ("C", None, None, None), ("D", None, None, None)
    ]
    assert rows(w.stg_trial_conditions) == [("C", "7"), ("C", "Flu")]
    assert [row[0] for row in rows(unreadable(w.raw_studies), "nct_id")] == ["E", "F", "G", "H", "I"]


def test_the_status_of_applications_reads_each_document_once(spark):
    given = [application("1", "A", [submission(status="TA"), submission()]), application("2", "B", []), application("3", "C"), ("4", "no json")]
    raw = spark.createDataFrame(given, "application_number string, payload string").selectExpr("*", "timestamp '2020-01-01' as fetched_at")
    status = application_status(parse_applications(raw))
    assert status._jdf.queryExecution().optimizedPlan().toString().count("variant_get") == 1
    assert rows(status) == [("1", "A", True, D(2020, 1, 31))]
