from __future__ import annotations

import datetime
import json

import pytest
from registry import rows
from pyspark.sql import functions as F

from cohortline.sources.pages import NO_KEY, UNREADABLE_PAGE, after_key, unpack_pages
from cohortline.streaming.ingest import compact, current_records, ingest, land, merge_log, raw_table, record_store, rejected_records, trim_log

T = datetime.datetime(2024, 1, 1)
FIRST = [{"trial": "T-10", "title": "Aspirin in flu"}, {"trial": "T-11", "title": "Zinc in colds"}]
SECOND = [{"trial": "T-20", "title": "Honey in cough"}]


class Registry:
    """A landing folder, its log and the stream's checkpoint."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def land(self, page, trials, at=T, **more):
        body = json.dumps({"trials": trials, **more} if trials is not None else more)
        frame = self.spark.createDataFrame([(page, at, body)], "page bigint, fetched_at timestamp, body string")
        land(frame.coalesce(1), str(self.folder / "landing"))

    def ingest(self, **options):
        paths = (str(self.folder / name) for name in ("landing", "log", "checkpoint"))
        return ingest(self.spark, *paths, "trials", "trial", **options)

    def titles(self, **options):
        current = current_records(self.spark, str(self.folder / "log"), **options)
        return rows(current, "record_id", F.get_json_object("payload", "$.title"))

    def versions(self):
        return self.spark.read.parquet(str(self.folder / "log")).where("not rejected")

    def rejected(self):
        return rows(rejected_records(self.spark, str(self.folder / "log")), "page", "pos", "reason")

    def land_text(self, page, body, at=T):
        frame = self.spark.createDataFrame([(page, at, body)], "page bigint, fetched_at timestamp, body string")
        land(frame.coalesce(1), str(self.folder / "landing"))


@pytest.fixture
def registry(spark, tmp_path):
    return Registry(spark, tmp_path)


def trial(key, title):
    return {"trial": key, "title": title}


def test_fresh_run_takes_all_pages(registry):
    registry.land(0, FIRST, next="2")
    registry.land(1, SECOND)
    registry.ingest()
    assert [key for key, _ in registry.titles()] == ["T-10", "T-11", "T-20"]
    table = raw_table(current_records(registry.spark, str(registry.folder / "log")), "trial")
    assert table.columns == ["trial", "payload", "fetched_at"]


def test_next_run_takes_only_new_pages(registry):
    registry.land(0, FIRST)
    registry.ingest()
    registry.land(1, SECOND)
    registry.ingest()
    per_batch = registry.versions().groupBy("batch_id").count()
    assert rows(per_batch) == [(0, 2), (1, 1)]
    assert len(registry.titles()) == 3


def test_rerun_with_nothing_new_changes_nothing(registry):
    registry.land(0, FIRST)
    registry.ingest()
    before = rows(registry.versions(), "record_id", "payload")
    registry.ingest()
    assert rows(registry.versions(), "record_id", "payload") == before


def test_later_page_and_position_win(registry):
    registry.land(0, [trial("a", "old"), trial("b", "first"), trial("b", "second")])
    registry.land(1, [trial("a", "new")])
    registry.ingest(files_per_batch=1)
    assert registry.titles() == [("a", "new"), ("b", "second")]


def test_page_without_records(registry):
    registry.land(0, None, next="2")
    registry.land(1, SECOND)
    registry.ingest()
    assert len(registry.titles()) == 1


def test_crash_repeats_the_batch_without_loss_or_doubles(registry, monkeypatch):
    """The second micro-batch writes its records, then dies before it is committed."""
    from pyspark.sql import DataFrameWriter

    registry.land(0, FIRST)
    registry.ingest()
    registry.land(1, SECOND)
    write = DataFrameWriter.parquet

    def write_then_fail(self, path, *args, **kwargs):
        write(self, path, *args, **kwargs)
        raise OSError("executor host lost")

    monkeypatch.setattr(DataFrameWriter, "parquet", write_then_fail)
    with pytest.raises(Exception, match="executor host lost"):
        registry.ingest()
    monkeypatch.undo()
    registry.ingest()
    assert [key for key, _ in registry.titles()] == ["T-10", "T-11", "T-20"]
    assert registry.versions().count() == 3


def test_snapshot_stands_for_the_batches_before_it(registry):
    registry.land(0, [trial("a", "old"), trial("b", "kept")])
    registry.ingest()
    target = str(registry.folder / "snapshot")
    current_records(registry.spark, str(registry.folder / "log")).write.parquet(target)
    registry.land(1, [trial("a", "new")])
    registry.ingest()
    snapshot = registry.spark.read.parquet(target)
    assert registry.titles(snapshot=snapshot, after_batch=0) == registry.titles() == [("a", "new"), ("b", "kept")]


def test_missing_list_is_empty(spark):
    pages = spark.createDataFrame([(0, '{"results": [1, 2]}'), (1, "{}")], "page int, body string")
    assert rows(unpack_pages(pages, "results")) == [(0, 0, "1"), (0, 1, "2")]


def test_keyset_is_exclusive_ascending_and_paged(spark):
    records = spark.createDataFrame([("d",), ("b",), ("a",), ("c",)], "k string")
    assert [r.k for r in after_key(records, "k", None, 2).collect()] == ["a", "b"]
    assert [r.k for r in after_key(records, "k", "b", 2).collect()] == ["c", "d"]
    assert after_key(records, "k", "d").isEmpty()


BAD_PAGES = {
    10: '{"trials": [{"trial": "T-30"}, {"tri',
    11: '{"trials": {"trial": "T-31"}}',
    12: "[1, 2]",
    13: "",
    14: None,
    15: "no json",
}


def test_what_cannot_be_read_is_set_aside_with_its_reason(registry):
    registry.land(0, FIRST)
    registry.land(1, [{"title": "keyless"}, trial("T-12", "good"), {"trial": None, "title": "null key"}])
    for page, body in BAD_PAGES.items():
        registry.land_text(page, body)
    registry.ingest()
    assert [key for key, _ in registry.titles()] == ["T-10", "T-11", "T-12"]
    assert registry.rejected() == [(1, 0, NO_KEY), (1, 2, NO_KEY), *((page, None, UNREADABLE_PAGE) for page in BAD_PAGES)]
    # Accepted and rejected together are all that was landed: 5 records and 6 pages.
    assert registry.versions().count() + len(registry.rejected()) == 11


def test_a_job_can_stop_at_rejects(registry):
    registry.land_text(0, "no json")
    with pytest.raises(Exception, match="rejected"):
        registry.ingest(rejects="fail")
    assert registry.rejected() == [(0, None, UNREADABLE_PAGE)]
    registry.ingest(rejects="keep")
    assert registry.rejected() == [(0, None, UNREADABLE_PAGE)]


def test_a_page_landed_again_replaces_the_former(registry):
    for title in ("first", "second", "third"):
        registry.land(0, [trial("a", title)])
        registry.ingest()
    assert registry.titles() == [("a", "third")]


def test_snapshots_are_made_from_the_one_before_and_the_newer_batches(registry, monkeypatch):
    log, snapshots = str(registry.folder / "log"), str(registry.folder / "snapshots")
    registry.land(0, [trial("a", "old"), trial("b", "kept")])
    registry.ingest()
    compact(registry.spark, log, snapshots)
    registry.land(1, [trial("a", "new"), trial("c", "more")])
    registry.ingest()
    second = compact(registry.spark, log, snapshots)
    full = current_records(registry.spark, log)
    columns = ("record_id", "payload", "page", "pos", "batch_id")
    assert rows(second, *columns) == rows(full, *columns)
    # Nothing new: the snapshot stands.
    assert compact(registry.spark, log, snapshots).inputFiles() == second.inputFiles()
    # The second one read batch 1 alone beside the first snapshot.
    first = registry.spark.read.parquet(f"{snapshots}/upto={0:012d}")
    read = current_records(registry.spark, log, first, 0)._jdf.queryExecution().executedPlan().toString()
    assert "batch_id#" in read and "> 0" in read


def test_batches_are_merged_into_the_buckets_they_touch(registry):
    log = str(registry.folder / "log")
    store = record_store(registry.spark, str(registry.folder / "store"), 8)
    registry.land(0, [trial(f"T-{n}", "old") for n in range(40)])
    registry.ingest()
    assert merge_log(registry.spark, log, store) == 1
    before = store.manifests.newest()[1]["files"]
    registry.land(1, [{"title": "keyless"}, trial("T-3", "new")])
    registry.ingest()
    assert merge_log(registry.spark, log, store) == 2
    # Nothing new: nothing is written.
    assert merge_log(registry.spark, log, store) == 2
    after = store.manifests.newest()[1]["files"]
    assert sum(after[bucket] != path for bucket, path in before.items()) == 1
    columns = ("record_id", "payload", "page", "pos", "batch_id")
    assert rows(store.read(), *columns) == rows(current_records(registry.spark, log), *columns)
    # Batches that the store holds may go, and later ones are merged on.
    trim_log(registry.spark, log, store)
    assert store.manifests.folders(log) == []
    registry.land(2, [trial("T-4", "newer")])
    registry.ingest()
    merge_log(registry.spark, log, store)
    assert store.read().count() == 40 and store.progress == 2
