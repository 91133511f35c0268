"""Tables kept up to date from changed records equal those built anew, and read the changes only."""

from __future__ import annotations

import json
import random

import pytest
from registry import application, rows, study, submission

from cohortline.incremental import LiveMarts
from cohortline.keyed import KeyedStore
from cohortline.streaming.ingest import ORDER, RECORDS, raw_table, record_store
from cohortline.warehouse import Warehouse

NAMES = ("fct_trials", "bridge_trial_condition", "condition_funnel", "metric_phase_transition")


class Registry:
    """Both sources as stores, and the tables over them."""

    def __init__(self, spark, folder, workspace):
        self.spark, self.workspace, self.batch = spark, workspace, 0
        self.studies, self.applications = (record_store(spark, f"{folder}/{name}", 4) for name in ("studies", "applications"))
        self.live = LiveMarts(spark, f"{folder}/live", self.studies, self.applications, 4)

    def take(self, store, *documents):
        given = [(key, payload, None, self.batch, n, self.batch) for n, (key, payload) in enumerate(documents)]
        store.merge(self.spark.createDataFrame(given, RECORDS), ORDER, progress=self.batch)
        self.batch += 1

    def rebuilt(self) -> Warehouse:
        tables = (raw_table(self.studies.read(), "nct_id"), raw_table(self.applications.read(), "application_number"))
        return Warehouse(*tables, type(self.workspace)(self.spark, self.workspace.fresh("rebuilt")))

    def check(self):
        built = self.rebuilt()
        for name in NAMES:
            ours, theirs = getattr(self.live, name), built.table(name)
            assert sorted(ours.columns) == sorted(theirs.columns)
            assert {c: t for c, t in ours.dtypes} == {c: t for c, t in theirs.dtypes}, name
            assert rows(ours, *theirs.columns) == rows(theirs), name


@pytest.fixture
def registry(spark, tmp_path, workspace):
    return Registry(spark, tmp_path, workspace)


def test_a_small_batch_equals_the_full_build_conditions_gone_included(registry):
    acme = {"sponsor": " acme", "phases": ["PHASE2"], "status": "COMPLETED"}
    registry.take(
        registry.studies,
        study("A", conditions=["Flu", "Cold"], **acme),
        study("B", conditions=["Flu"], phases=["PHASE3"], sponsor="Other"),
        study("C", phases=["PHASE2", "PHASE3"]),
        ("X", '{"protocolSection": {'),
    )
    registry.take(registry.applications, application("1", "ACME", [submission()]), application("2", "other", [submission(status="TA")]))
    registry.live.refresh()
    registry.check()
    assert rows(registry.live.condition_funnel, "condition_name", "condition_approved_trials") == [("Flu", 1), (None, 0)]
    # A loses its first condition, B moves to another one, C becomes unreadable, X readable, D is new.
    registry.take(
        registry.studies,
        study("A", conditions=["Cold"], **acme),
        study("B", conditions=["Gout"], phases=["PHASE3"], sponsor="Acme"),
        ("C", "no json"),
        study("X", conditions=["Flu"], phases=["PHASE3"], sponsor="Other"),
        study("D", start="2020-01", end="2020-02"),
    )
    registry.live.refresh()
    registry.check()
    assert rows(registry.live.condition_funnel, "condition_name", "trial_count") == [("Cold", 1), ("Flu", 1), ("Gout", 1), (None, 1)]
    assert len(rows(registry.live.bridge_trial_condition.where("nct_id = 'A'"))) == 1
    # An application alone: an approval withdrawn, an applicant gone, another new.
    registry.take(registry.applications, application("1", "ACME", [submission(status="TA")]), application("2", "other"), application("3", "x", [submission()]))
    registry.live.refresh()
    registry.check()


def test_many_random_batches_equal_the_full_build(registry):
    draw = random.Random(11)
    conditions, sponsors = ["Flu", "Cold", "Gout", " Flu ", ""], ["Acme", "acme ", "Other", None]
    for _ in range(3):
        registry.take(
            registry.studies,
            *(
                study(
                    f"N{draw.randrange(25)}",
                    conditions=draw.sample(conditions, draw.randrange(4)),
                    phases=draw.sample(["PHASE1", "PHASE2", "PHASE3"], draw.randrange(3)),
                    sponsor=draw.choice(sponsors),
                )
                for _ in range(15)
            ),
        )
        registry.take(
            registry.applications,
            *(application(str(draw.randrange(6)), draw.choice(sponsors), [submission(status=draw.choice(["AP", "TA"]))]) for _ in range(4)),
        )
    # Three versions of each source are taken in one after the other.
    registry.live.refresh()
    registry.check()


def test_a_refresh_reads_the_buckets_of_changed_keys_only(registry):
    registry.take(registry.studies, *(study(f"N{n}", conditions=[f"C{n % 7}"], sponsor="Acme") for n in range(60)))
    registry.live.refresh()
    before = {name: store.manifests.newest()[1].get("files", {}) for name, store in registry.live.stores.items()}
    registry.take(registry.studies, study("N3", conditions=["C3"], sponsor="Other"))
    version = registry.studies.version
    changes = registry.studies.changes(version)
    assert len(changes.inputFiles()) == 1 and [r["record_id"] for r in changes.collect()] == ["N3"]
    registry.live.refresh()
    for name, most in {"fct_trials": 1, "trial_stages": 1, "bridge_trial_condition": 1, "funnel_counts": 2}.items():
        after = registry.live.stores[name].manifests.newest()[1]["files"]
        assert len(before[name]) == 4 and sum(after[b] != before[name][b] for b in after) <= most, name
    registry.check()


def test_a_lost_run_goes_on_and_readers_see_whole_runs(registry, monkeypatch):
    registry.take(registry.studies, study("A", conditions=["Flu"], phases=["PHASE2"]), study("B", conditions=["Flu"]))
    registry.live.refresh()
    former = {name: rows(getattr(registry.live, name)) for name in NAMES}
    registry.take(registry.studies, study("A", conditions=["Cold"], phases=["PHASE2"]))
    add = KeyedStore.add

    def lost(self, *args, **kwargs):
        raise OSError("driver lost")

    monkeypatch.setattr(KeyedStore, "add", lost)
    with pytest.raises(OSError, match="driver lost"):
        registry.live.refresh()
    monkeypatch.setattr(KeyedStore, "add", add)
    # Facts are ahead of the counts by now; readers still see all tables of the former run.
    assert registry.live.stores["fct_trials"].progress > registry.live.stores["funnel_counts"].progress
    assert {name: rows(getattr(registry.live, name)) for name in NAMES} == former
    registry.live.refresh()
    registry.check()
    state = registry.live.manifests.newest()
    registry.live.refresh()
    assert registry.live.manifests.newest() == state


def test_no_records_give_empty_tables(registry):
    registry.live.refresh()
    assert all(getattr(registry.live, name).isEmpty() for name in NAMES)


def test_documents_are_parsed_from_changes_not_from_the_table(registry):
    registry.take(registry.studies, *(study(f"N{n}", title=json.dumps(n)) for n in range(30)))
    registry.take(registry.studies, study("N1", title="new"))
    _, before, after = registry.live._parsed(registry.studies, 2, "nct_id", lambda raw: raw)
    assert rows(before, "nct_id") == rows(after, "nct_id") == [("N1",)]
