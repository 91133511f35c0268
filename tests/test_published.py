"""Publication by one write: readers see one run, of two runs one is left whole, answers belong to a run."""

from __future__ import annotations

import pytest
from registry import application, rows, study, submission

from cohortline import refresh as job
from cohortline.manifest import Conflict
from cohortline.plans import quality
from cohortline.refresh import refresh
from cohortline.sinks import layers
from cohortline.sinks.published import Published, forget_runs, open_run, publish_run
from cohortline.warehouse import MODELS

APPLICATIONS = [application("1", "acme", [submission()])]
COUNT = "SELECT count(*) AS n FROM {fct_trials} WHERE phase = :phase"


def studies(size):
    return [
        study(f"N{n}", status="COMPLETED", sponsor="Acme", start="2000-01", end="2001-01", phases=["PHASE2"], conditions=["Flu"], results=True)
        for n in range(size)
    ]


@pytest.fixture
def run(make_warehouse, tmp_path):
    """A refresh of so many trials, in one folder."""

    def start(size, **options):
        raw = make_warehouse(studies(size), APPLICATIONS)
        return refresh(raw.raw_studies, raw.raw_applications, str(tmp_path / "out"), strict=False, **options)

    start.folder = str(tmp_path / "out")
    return start


def sizes(published: Published) -> set[int]:
    """Rows of the tables that have one for each trial."""
    return {published.table(name).count() for name in ("studies_parsed", "stg_trials", "fct_trials", "bridge_trial_condition", "metric_phase_transition")}


def test_a_reader_during_publishing_sees_one_run(spark, run, monkeypatch):
    run(2)
    point, seen = layers._point, []

    def watched(*args):
        seen.append((open_run(spark, run.folder).version, sizes(open_run(spark, run.folder))))
        point(*args)

    publish = job.publish_run
    before = []

    def watched_publish(*args):
        before.append(sizes(open_run(spark, run.folder)))
        return publish(*args)

    monkeypatch.setattr(layers, "_point", watched)
    monkeypatch.setattr(job, "publish_run", watched_publish)
    former = open_run(spark, run.folder)
    run(3)
    # Before the one write all is the former run, after it the new one; what was open stays open.
    assert before == [{2}] and seen and all(state == (2, {3}) for state in seen)
    assert sizes(former) == {2} and sizes(open_run(spark, run.folder, 1)) == {2}
    assert set(open_run(spark, run.folder).names) >= {name for name, model in MODELS.items() if model.layer in ("staging", "marts", "metrics")}


def test_of_two_refreshes_at_once_one_is_left_whole(spark, run, monkeypatch):
    run(2)
    publish = job.publish_run

    def overtaken(*args):
        monkeypatch.setattr(job, "publish_run", publish)
        run(4)
        return publish(*args)

    monkeypatch.setattr(job, "publish_run", overtaken)
    with pytest.raises(Conflict):
        run(3)
    assert sizes(open_run(spark, run.folder)) == {4}
    assert spark.table("marts.fct_trials").count() == spark.table("metrics.metric_phase_transition").count() == 4


def test_a_partial_run_carries_the_other_tables_over(spark, run, make_warehouse):
    run(2)
    bad = make_warehouse([*studies(2), study("N9", status="MYSTERY", results=True)], [*APPLICATIONS, application("7", "new", [submission()])])
    for _ in range(3):
        with pytest.raises(quality.QualityError):
            refresh(bad.raw_studies, bad.raw_applications, run.folder, partial=True, keep_runs=1)
        forget_runs(spark, run.folder, 1)
    published = open_run(spark, run.folder)
    assert published.table("fct_approvals").count() == 2 and published.table("fct_trials").count() == 2


def test_answers_are_read_again_until_a_new_run_or_their_end(spark, run, monkeypatch):
    run(2)
    asked = []
    sql = Published.sql
    monkeypatch.setattr(Published, "sql", lambda self, *args: asked.append(args) or sql(self, *args))

    def answer(**options):
        return rows(open_run(spark, run.folder).answer(COUNT, {"phase": "PHASE2"}, **options))

    assert answer() == answer() == [(2,)] and len(asked) == 1
    # Other arguments are another answer, and one that has expired is computed again.
    assert rows(open_run(spark, run.folder).answer(COUNT, {"phase": "PHASE3"})) == [(0,)] and len(asked) == 2
    assert answer(kept_for=0) == [(2,)] and len(asked) == 3
    run(3)
    assert answer() == [(3,)] and len(asked) == 4
    assert rows(open_run(spark, run.folder, 1).answer(COUNT, {"phase": "PHASE2"})) == [(2,)] and len(asked) == 4


def test_nothing_published_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="published"):
        open_run(spark, str(tmp_path / "none"))


def test_a_warehouse_is_published_without_a_refresh(spark, make_warehouse, tmp_path):
    w = make_warehouse(studies(2), APPLICATIONS)
    assert publish_run(w, str(tmp_path / "p"), 0, {"fct_trials"}) == 1
    with pytest.raises(Conflict):
        publish_run(w, str(tmp_path / "p"), 0)
    assert open_run(spark, str(tmp_path / "p")).names[0] == "fct_trials"
