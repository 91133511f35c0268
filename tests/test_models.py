from __future__ import annotations

import random
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal
from hashlib import md5

import pytest
from registry import application, rows, study, submission
from pyspark.sql import functions as F

from cohortline.operators import active_spans, approval_by_application, count_by_year, latest_by_key
from cohortline.plans import dashboards, insights, serving


def digest(*fields) -> str:
    return md5("||".join("" if f is None else str(f) for f in fields).encode()).hexdigest()


def rounded(part, whole, digits=4):
    if not whole:
        return None
    quotient = Decimal(part) / Decimal(whole)
    return float(quotient.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


# Sponsors


@pytest.mark.parametrize(
    "classes, expected",
    [
        (["OTHER", "FED", "OTHER"], "OTHER"),
        (["OTHER", "FED"], "FED"),
        ([None, None, "NIH"], None),
        ([None, "NIH"], "NIH"),
        (["NIH", "NIH", None, None], "NIH"),
    ],
)
def test_sponsor_class_is_the_mode(make_warehouse, classes, expected):
    w = make_warehouse([study(f"N{i}", sponsor="Acme", sponsor_class=c) for i, c in enumerate(classes)])
    assert rows(w.stg_sponsors) == [("Acme", expected)]
    assert rows(w.dim_sponsor, "sponsor_class", "trials_total") == [(expected, len(classes))]


def test_trials_without_a_sponsor_have_no_key(make_warehouse):
    w = make_warehouse([study("A", sponsor=""), study("B"), study("C", sponsor="Acme", status="TERMINATED")])
    assert rows(w.dim_sponsor, "sponsor_name") == [("Acme",)]
    assert rows(w.fct_trials, "nct_id", "sponsor_key", "is_terminated") == [
        ("A", None, None),
        ("B", None, None),
        ("C", digest("Acme"), True),
    ]


def test_status_missing_leaves_the_flag_null(make_warehouse):
    w = make_warehouse([study("A"), study("B", status="COMPLETED")])
    assert rows(w.fct_trials, "nct_id", "is_terminated") == [("A", None), ("B", False)]
    assert rows(serving.why_stopped_coverage(w.fct_trials)) == [(0, 0)]


# Keys taken in place of joins


def test_keys_equal_those_a_lookup_would_find(make_warehouse):
    w = make_warehouse(
        [
            study("A", sponsor="Acme", conditions=["Flu", "Gout"], interventions=[{"name": "X", "type": "DRUG"}]),
            study("B", sponsor="Beta", conditions=["Flu"], interventions=[{"name": "X"}]),
            study("C"),
        ]
    )
    looked_up = w.stg_trials.join(w.dim_sponsor, "sponsor_name", "left").select("nct_id", "sponsor_key")
    assert rows(looked_up) == rows(w.fct_trials, "nct_id", "sponsor_key")
    pairs = w.stg_trial_conditions.join(w.dim_condition, "condition_name").select("nct_id", "condition_key")
    assert rows(pairs) == rows(w.bridge_trial_condition, "nct_id", "condition_key")
    triples = w.stg_trial_interventions.join(w.dim_intervention, ["intervention_name", "intervention_type"])
    assert rows(triples.select("nct_id", "intervention_key")) == rows(
        w.bridge_trial_intervention, "nct_id", "intervention_key"
    )
    assert rows(w.dim_condition, "mesh_term", "therapeutic_area") == [(None, None)] * 2


# Approvals


def test_documents_and_events_give_the_same_applications(make_warehouse):
    w = make_warehouse(
        applications=[
            application("1", "a", [submission(date="20200201"), submission("SUPPL", date="20190101")]),
            application("2", "a", [submission(status="TA")]),
            application("3", None, [submission(status="TA"), submission("SUPPL", status=None)]),
            application("4", "b", [submission(status=None)]),
            application("5", "b", [submission(date=None)]),
            application("6", "b", []),
            application("7", "b"),
        ]
    )
    assert rows(w.application_status) == rows(approval_by_application(w.fct_approvals))
    assert rows(w.application_status, "application_number", "is_approved") == [
        ("1", True),
        ("2", False),
        ("3", False),
        ("4", None),
        ("5", True),
    ]
    assert rows(serving.approvals_by_sponsor_class_year(w.applicant_years)) == [(2019, "a", 1)]
    assert rows(serving.top_sponsors_by_approval_count(w.application_status)) == [("a", 1), ("b", 1)]


# Phase transition


def test_representative_condition_has_the_smallest_key(make_warehouse):
    names = ["Flu", "Gout", "Asthma"]
    w = make_warehouse([study("A", conditions=names), study("B", conditions=["Gout"]), study("C")])
    smallest = min(names, key=digest)
    found = rows(w.metric_phase_transition, "nct_id", "condition_name", "condition_key", "multi_condition_flag")
    assert found == [
        ("A", smallest, digest(smallest), True),
        ("B", "Gout", digest("Gout"), False),
        ("C", None, None, False),
    ]


def test_applicant_match_ignores_case_and_spaces(make_warehouse):
    w = make_warehouse(
        [study("A", sponsor="Acme"), study("B", sponsor="Beta"), study("C", sponsor="Gamma"), study("D")],
        [application("1", " acme ", [submission()]), application("2", "GAMMA", [submission(status=None)])],
    )
    assert rows(w.metric_phase_transition, "nct_id", "matched_to_fda", "has_fda_approval") == [
        ("A", True, True),
        ("B", False, False),
        ("C", True, False),
        ("D", False, False),
    ]


def test_funnel_ratios(make_warehouse):
    w = make_warehouse(
        [
            study("A", conditions=["Flu"], phases=["PHASE2", "PHASE3"]),
            study("B", conditions=["Flu"], phases=["PHASE3"]),
            study("C", conditions=["Gout"], phases=["PHASE3"]),
            study("D", phases=["PHASE2"]),
        ]
    )
    found = rows(w.metric_phase_transition, "nct_id", "condition_phase2_trials", "phase2_to_phase3_rate")
    assert found == [("A", 1, 2.0), ("B", 1, 2.0), ("C", 0, None), ("D", 1, 0.0)]
    # Trials without a condition are a group of their own, shown on the dashboard.
    shown = serving.phase_funnel_by_condition(w.condition_funnel, 1)
    assert rows(shown, "condition_name") == [("Flu",), (None,)]
    distinct = w.metric_phase_transition.select(*serving.FUNNEL_COLUMNS).distinct()
    assert rows(distinct) == rows(w.condition_funnel, *serving.FUNNEL_COLUMNS)


# Durations


def test_duration_trends(make_warehouse):
    w = make_warehouse(
        [
            study("A", start="2000-01-01", end="2000-01-11", phases=["PHASE1"]),
            study("B", start="2000-02-01", end="2000-02-01"),
            study("C", start="2000-03-01", end="2000-02-28", phases=["PHASE1"]),
            study("D", start="2003-01-01", end="2003-01-03", phases=["PHASE1"]),
            study("E", start="2003-01-01"),
            study("F", end="2003-01-01"),
            study("G", start="2004-01-01", end="2004-01-02"),
        ]
    )
    # 2000 holds -2, 0 and 10 days; the next existing year is 2003.
    assert rows(w.metric_duration_trends) == [
        (2000, 3, -1.0, 0.0, 5.0, None, None, None),
        (2003, 1, 2.0, 2.0, 2.0, 0.0, 2.0, None),
        (2004, 1, 1.0, 1.0, 1.0, 2.0, -1.0, -50.0),
    ]
    by_phase = w.metric_duration_trends_by_phase.drop("duration_by_phase_key")
    assert rows(by_phase) == [
        (2000, "PHASE1", 2, 1.0, 4.0, 7.0, None, None),
        (2003, "PHASE1", 1, 2.0, 2.0, 2.0, 4.0, -2.0),
    ]


def test_percentiles_match_interpolation(make_warehouse):
    rng = random.Random(5)
    days = [rng.randint(-50, 400) for _ in range(37)]
    start = F.lit("2001-05-05").cast("date")
    w = make_warehouse([study("Z")])
    trials = w.spark.createDataFrame([(d,) for d in days], "d int").select(
        start.alias("start_date"), F.date_add(start, F.col("d")).alias("end"), F.lit(None).cast("string").alias("phase")
    )
    w._tables["fct_trials"] = trials.withColumn("duration_days", F.date_diff("end", "start_date"))
    ordered = sorted(days)

    def at(share):
        place = share * (len(ordered) - 1)
        low = int(place)
        high = min(low + 1, len(ordered) - 1)
        return ordered[low] + (ordered[high] - ordered[low]) * (place - low)

    row = w.metric_duration_trends.first()
    assert [row.p25_duration_days, row.median_duration_days, row.p75_duration_days] == [at(0.25), at(0.5), at(0.75)]


# Cohorts


def test_reversed_span_adds_no_activity_and_lowers_the_baseline(make_warehouse):
    w = make_warehouse(
        [
            study("A", sponsor="a", start="2000-05-01", end="1999-01-01"),
            study("B", sponsor="a", start="2002-05-01", end="2003-01-01"),
            study("C", sponsor="b", start="2001-05-01"),
            study("D", sponsor="c", end="2001-05-01"),
        ]
    )
    columns = ["cohort_year", "activity_year", "active_sponsor_count", "cohort_launch_sponsor_count"]
    assert rows(w.metric_sponsor_cohorts, *columns, "cohort_sponsor_count") == [
        (2000, 2002, 1, 1, 1),
        (2000, 2003, 1, 1, 1),
        (2001, 2001, 1, 1, 1),
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_cohorts_against_brute_force(make_warehouse, seed):
    rng = random.Random(seed)
    # One sponsor holds a third of all trials.
    sponsors = ["hot"] * 10 + [f"s{i}" for i in range(20)]
    trials = []
    for i in range(200):
        start = rng.choice([None, *range(1995, 2005)])
        end = rng.choice([None, *range(1994, 2010)])
        trials.append((f"N{i}", rng.choice([*sponsors, None]), start, end, rng.choice(["COMPLETED", "TERMINATED"])))
    w = make_warehouse(
        study(n, sponsor=s, start=f"{a}-01-01" if a else None, end=f"{b}-01-01" if b else None, status=status)
        for n, s, a, b, status in trials
    )
    first, active, total, done = {}, defaultdict(set), Counter(), Counter()
    for _, sponsor, start, end, status in trials:
        if sponsor is None:
            continue
        total[sponsor] += 1
        done[sponsor] += status == "COMPLETED"
        if start is None:
            continue
        first[sponsor] = min(first.get(sponsor, 9999), start)
        active[sponsor].update(range(start, (end or start) + 1))
    counts = Counter((first[s], y) for s in first for y in active[s] if y >= first[s])
    expected = []
    for cohort, year in counts:
        launch = counts[cohort, min(y for c, y in counts if c == cohort)]
        members = [s for s in first if first[s] == cohort]
        rates = [Decimal(str(rounded(done[s], total[s]))) for s in members]
        expected.append(
            (
                digest(cohort, year),
                cohort,
                year,
                year - cohort,
                counts[cohort, year],
                launch,
                rounded(counts[cohort, year], launch),
                len(members),
                sum(total[s] for s in members),
                sum(done[s] for s in members),
                rounded(sum(rates), len(members)),
            )
        )
    assert rows(w.metric_sponsor_cohorts) == sorted(expected)


def test_spans_are_merged_and_counted_without_a_row_for_each_year(spark):
    trials = spark.sql("""
        select k, make_date(a, 1, 1) as s, make_date(b, 1, 1) as e from values
        ('x', 2000, 2002), ('x', 2000, 2001), ('x', 2003, 2004), ('x', 2010, 2009), ('x', 2008, 2012), ('x', 2009, 2010),
        ('y', 2001, null), ('y', null, 2004), ('z', 2005, 2004), (null, 2000, 2001), ('w', 2000, 2000), ('w', 2002, 2002)
        as t(k, a, b)""")
    spans = active_spans(trials, "k", "s", "e")
    assert "Generate" not in spans._jdf.queryExecution().executedPlan().toString()
    found = {row.k: (row.first_year, [tuple(span) for span in row.spans]) for row in spans.collect()}
    assert found == {
        "w": (2000, [(2000, 2000), (2002, 2002)]),
        "x": (2000, [(2000, 2004), (2008, 2012)]),
        "y": (2001, [(2001, 2001)]),
        "z": (2005, []),
    }
    counted = count_by_year(spans, "first_year", "spans", "year", "n")
    expected = {(2000, year): 1 for year in (2001, 2003, 2004, *range(2008, 2013))}
    expected |= {(2000, 2000): 2, (2000, 2002): 2, (2001, 2001): 1}
    assert {(row.first_year, row.year): row.n for row in counted.collect()} == expected


# Empty input, selections


def test_empty_registry_builds(make_warehouse):
    w = make_warehouse()
    w.build_all()
    assert w.metric_phase_transition.isEmpty() and w.metric_sponsor_cohorts.isEmpty()
    scorecard = serving.pipeline_trust_scorecard(w.condition_funnel, w.dim_condition, w.fct_trials)
    assert rows(scorecard) == [(None, None, None, None, None)]


def test_empty_selection_means_all_or_nothing(make_warehouse):
    w = make_warehouse([study("A", sponsor="a", sponsor_class="NIH", start="2000-01-01", end="2000-02-01", phases=["PHASE1"])])
    assert dashboards.league_ranked(w.dim_sponsor, w.workspace, []).count() == 1
    assert dashboards.league_ranked(w.dim_sponsor, w.workspace, ["FED"]).isEmpty()
    assert dashboards.duration_phase_series_truncated(w.metric_duration_trends_by_phase, []).isEmpty()
    assert dashboards.cohort_compare(w.metric_sponsor_cohorts, []).isEmpty()
    # 2000 is a default cohort; without one of those the first five are shown.
    assert rows(dashboards.cohort_compare(w.metric_sponsor_cohorts)) == [(2000, 0, 1.0)]


def test_first_cohorts_are_the_fallback(make_warehouse):
    w = make_warehouse([study(f"N{y}", sponsor=f"s{y}", start=f"{y}-01-01") for y in range(1981, 1988)])
    chosen = dashboards.cohort_compare(w.metric_sponsor_cohorts, measure="active_sponsor_count")
    assert rows(chosen, "cohort_year") == [(y,) for y in range(1981, 1986)]


def test_censored_and_reliable_overlap_at_the_cutoff(make_warehouse):
    w = make_warehouse(
        [study(f"N{y}", start=f"{y}-01-01", end=f"{y}-02-01") for y in (2016, 2017, 2018)]
    )
    split = dashboards.duration_censor_split(w.metric_duration_trends)
    assert rows(split, "segment", "start_year") == [
        ("censored", 2017),
        ("censored", 2018),
        ("reliable", 2016),
        ("reliable", 2017),
    ]


def test_latest_by_key_orders_by_time_page_and_position(spark):
    versions = [("a", 1, 0, 0), ("a", 1, 0, 1), ("a", 1, 1, 0), ("b", 2, 0, 0), ("b", 1, 9, 9)]
    frame = spark.createDataFrame(versions, "k string, fetched_at int, page int, pos int")
    assert rows(latest_by_key(frame, "k")) == [("a", 1, 1, 0), ("b", 2, 0, 0)]


def test_page_defaults_leave_out_what_the_pages_leave_out(make_warehouse):
    w = make_warehouse(
        [
            study("N1", sponsor="a", sponsor_class="FED", phases=["NA"], start="2000-01", end="2001-01"),
            study("N2", sponsor="b", phases=["EARLY_PHASE1"], start="2000-01", end="2001-01"),
            study("N3", sponsor="b", phases=["PHASE9"], start="2000-01", end="2001-01"),
            *(study(f"P{k}", sponsor="c", phases=[f"Z{k}"], start="2000-01", end="2001-01") for k in range(4)),
        ]
    )
    ranked = dashboards.league_ranked(w.dim_sponsor, w.workspace)
    assert rows(ranked, "rank", "sponsor_name") == [(1, "a")]
    assert dashboards.league_ranked(w.dim_sponsor, w.workspace, []).count() == 3
    # None of the four usual phases exists: the first four labels are shown.
    series = dashboards.duration_phase_series_truncated(w.metric_duration_trends_by_phase)
    assert [phase for phase, *_ in rows(series)] == ["EARLY_PHASE1", "NA", "PHASE9", "Z0"]


def test_an_extreme_without_a_condition_is_null(make_warehouse):
    w = make_warehouse(
        [study("N1", phases=["PHASE2"]), study("N2", phases=["PHASE2"], conditions=["Flu"]), study("N3", phases=["PHASE3"], conditions=["Flu"])]
    )
    band = insights.insight_phase2_band(w.condition_funnel, min_phase2_trials=1)
    assert set(rows(band, "highest_condition", "lowest_condition")) == {("Flu", None)}
