"""The keyed store: what a change rewrites, equality with a full rebuild, crashes and two writers."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql.types import StructType
from registry import rows

from cohortline import keyed
from cohortline.keyed import BEFORE, KeyedStore
from cohortline.manifest import Conflict, Manifests
from cohortline.operators import latest_by_key

SCHEMA = "k string, v string, at bigint"
ORDER = ("at",)


@pytest.fixture
def store(spark, tmp_path):
    return KeyedStore(spark, str(tmp_path / "store"), "k", StructType.fromDDL(SCHEMA), buckets=8, tracked=True)


def records(spark, *given):
    return spark.createDataFrame(list(given), SCHEMA)


def files(store) -> dict:
    return store.manifests.newest()[1]["files"]


def test_one_changed_key_rewrites_one_bucket(spark, store):
    store.merge(records(spark, *[(f"k{n}", "old", 1) for n in range(200)]), ORDER, progress=0)
    before = files(store)
    assert len(before) == 8
    store.merge(records(spark, ("k7", "new", 2)), ORDER, progress=1)
    after = files(store)
    assert sum(after[b] != before[b] for b in before) == 1 and after.keys() == before.keys()
    assert rows(store.read().where("v = 'new'"), "k", "at") == [("k7", 2)]
    assert store.read().count() == 200 and (store.version, store.progress) == (2, 1)
    # The former version can still be read.
    assert store.read(1).where("v = 'new'").isEmpty()


def test_merges_equal_a_full_rebuild_with_hot_keys_and_late_arrivals(spark, store):
    draw = random.Random(3)
    taken = []
    for batch in range(5):
        given = [(draw.choice(["hot", f"k{draw.randrange(60)}"]), f"{batch}-{n}", draw.randrange(1_000)) for n in range(150)]
        # No ties between versions of one key.
        given = [(k, v, at * 1_000 + batch * 150 + n) for n, (k, v, at) in enumerate(given)]
        taken += given
        store.merge(records(spark, *given), ORDER, progress=batch)
    assert rows(store.read()) == rows(latest_by_key(records(spark, *taken), "k", ORDER))


def test_changes_tell_what_was_and_what_is(spark, store):
    store.merge(records(spark, ("a", "1", 5), ("b", "1", 5)), ORDER)
    # A later one wins, an earlier one changes nothing, one of the same place wins, one is new.
    version = store.merge(records(spark, ("a", "2", 6), ("a", "3", 7), ("b", "0", 4), ("c", "1", 1)), ORDER)
    told = {r["k"]: (r["before"] and r["before"]["v"], r["after"]["v"]) for r in store.changes(version).collect()}
    assert told == {"a": ("1", "3"), "c": (None, "1")}
    version = store.merge(records(spark, ("b", "same place", 5)), ORDER)
    assert [(r["k"], r["before"]["v"]) for r in store.changes(version).collect()] == [("b", "1")]
    assert BEFORE not in store.read().columns


def test_a_crash_before_the_manifest_leaves_the_former_state(spark, store, monkeypatch):
    store.merge(records(spark, ("a", "1", 1), ("b", "1", 1)), ORDER, progress=0)

    def lost(*_):
        raise OSError("driver lost")

    monkeypatch.setattr(Manifests, "commit", lost)
    with pytest.raises(OSError, match="driver lost"):
        store.merge(records(spark, ("a", "2", 2)), ORDER, progress=1)
    monkeypatch.undo()
    assert rows(store.read(), "k", "v") == [("a", "1"), ("b", "1")] and store.progress == 0
    write = DataFrameWriter.parquet

    def write_then_fail(self, path, *args, **kwargs):
        write(self, path, *args, **kwargs)
        raise OSError("executor lost")

    monkeypatch.setattr(DataFrameWriter, "parquet", write_then_fail)
    with pytest.raises(OSError, match="executor lost"):
        store.merge(records(spark, ("a", "2", 2)), ORDER, progress=1)
    monkeypatch.undo()
    store.merge(records(spark, ("a", "2", 2)), ORDER, progress=1)
    assert rows(store.read(), "k", "v") == [("a", "2"), ("b", "1")]
    left = len(store.manifests.folders(f"{store.folder}/data"))
    store.vacuum(1)
    assert left == 4 and len(store.manifests.folders(f"{store.folder}/data")) == 2
    assert rows(store.read(), "k", "v") == [("a", "2"), ("b", "1")]


def test_of_two_writers_one_starts_over(spark, store, monkeypatch):
    store.merge(records(spark, ("a", "1", 1)), ORDER)
    newest = Manifests.newest
    raced = []

    def overtaken(self):
        state = newest(self)
        if not raced:
            raced.append(True)
            store.merge(records(spark, ("a", "first", 2)), ORDER)
        return state

    monkeypatch.setattr(Manifests, "newest", overtaken)
    with pytest.raises(Conflict):
        store.merge(records(spark, ("a", "second", 3)), ORDER)
    assert rows(store.read(), "v") == [("first",)]
    store.merge(records(spark, ("a", "second", 3)), ORDER)
    assert rows(store.read(), "v") == [("second",)]


def test_rows_of_a_key_are_replaced_or_removed(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "rows"), "k", StructType.fromDDL("k string, v string"), buckets=4)
    many = lambda *given: spark.createDataFrame(list(given), "k string, v string")
    store.replace(many(("a", ""), ("b", "")), many(("a", "1"), ("a", "2"), ("b", "1")))
    store.replace(many(("a", ""), ("c", "")), many(("c", "1")))
    assert rows(store.read()) == [("b", "1"), ("c", "1")]
    store.replace(many(("b", ""), ("c", "")), many().limit(0))
    assert store.read().isEmpty() and files(store) == {}


def test_signed_amounts_are_added_and_nothing_goes(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "sums"), ["g", "h"], StructType.fromDDL("g string, h string, n bigint, x bigint"), buckets=4)
    deltas = lambda *given: spark.createDataFrame(list(given), "g string, h string, n bigint, x bigint")
    store.add(deltas(("a", None, 2, 1), (None, "b", 1, 0), ("a", None, 1, 0)), "n")
    store.add(deltas(("a", None, -1, 1), (None, "b", -1, 0), ("c", "c", 1, 1)), "n")
    assert rows(store.read()) == [("a", None, 2, 2), ("c", "c", 1, 1)]


def test_another_number_of_buckets_keeps_rows_and_later_merges(spark, store):
    store.merge(records(spark, *[(f"k{n}", "old", 1) for n in range(50)]), ORDER, progress=4)
    store.rebucket(3)
    assert len(files(store)) == 3 and store.read().count() == 50 and store.progress == 4
    store.merge(records(spark, ("k1", "new", 2)), ORDER)
    assert store.read().count() == 50 and rows(store.read().where("v = 'new'"), "k") == [("k1",)]


def test_an_empty_store_and_an_empty_change(spark, store):
    assert store.read().isEmpty() and (store.version, store.progress) == (0, -1)
    store.merge(records(spark).limit(0), ORDER, progress=3)
    assert store.read().isEmpty() and (store.version, store.progress) == (1, 3)
    assert store.changes(1).isEmpty()


def test_null_keys_are_a_key(spark, store):
    store.merge(records(spark, (None, "1", 1), ("a", "1", 1)), ORDER)
    store.merge(records(spark, (None, "2", 2)), ORDER)
    assert rows(store.read(), "k", "v") == [("a", "1"), (None, "2")]


def test_stored_rows_that_a_change_does_not_concern_are_not_shuffled(spark, store, monkeypatch):
    spread, shuffled = KeyedStore._spread, []

    def counted(self, frame, buckets, rows):
        shuffled.append(frame.count())
        return spread(self, frame, buckets, rows)

    monkeypatch.setattr(KeyedStore, "_spread", counted)
    store.merge(records(spark, *[(f"k{n}", "old", 1) for n in range(2_000)], (None, "old", 1)), ORDER)
    assert shuffled == []
    store.merge(records(spark, ("k7", "new", 2), (None, "new", 2), ("other", "new", 2)), ORDER)
    # Two stored and three incoming rows, and few whose hashes fall on theirs.
    assert 5 <= shuffled[0] < 50
    store.merge(records(spark, ("k8", "new", 3)), ORDER)
    assert store.read().count() == 2_002
    assert rows(store.read().where("v = 'new'"), "k", "at") == [("k7", 2), ("k8", 3), ("other", 2), (None, 2)]


def test_a_bitmap_that_is_too_small_loses_no_row(spark, store, monkeypatch):
    monkeypatch.setattr(keyed, "MOST_BITS", keyed.CELL // 8)
    store.merge(records(spark, *[(f"k{n}", "old", 1) for n in range(3_000)]), ORDER)
    store.merge(records(spark, *[(f"k{n}", "new", 2) for n in range(0, 3_000, 3)]), ORDER)
    assert store.read().count() == 3_000 and store.read().where("v = 'new'").count() == 1_000
    assert store.changes(2).where("before.v = 'old' and after.v = 'new'").count() == 1_000


def test_a_store_of_the_former_hash_goes_on(spark, store, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(keyed, "HASH", keyed.FORMER_HASH)
        store.merge(records(spark, *[(f"k{n}", "old", 1) for n in range(50)]), ORDER)
    # States of that time do not tell.
    since, state = store.manifests.newest()
    store.manifests.commit(since, {name: value for name, value in state.items() if name != "hash"})
    store.merge(records(spark, *[(f"k{n}", "new", 2) for n in range(0, 50, 2)]), ORDER)
    assert store.read().count() == 50 and store.read().where("v = 'new'").count() == 25
