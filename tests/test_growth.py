"""What is written and shuffled, and that tasks and files do not grow with the tables."""

from __future__ import annotations

import os

from pyspark.sql.types import StructType
from registry import rows, study

from cohortline import keyed
from cohortline.incremental import LiveMarts
from cohortline.keyed import KeyedStore
from cohortline.plans.catalog import QUERIES
from cohortline.sources import benchmark_tables, documents
from cohortline.streaming.ingest import ORDER, record_store
from cohortline.warehouse import Warehouse
from cohortline.workspace import Workspace

SF_DIR = "/root/testdata/sf0.001"


def parts(folder: str) -> list[str]:
    return [f"{top}/{name}" for top, _, names in os.walk(folder) for name in names if name.endswith(".parquet")]


def test_a_source_is_landed_only_when_it_is_read(spark, workspace):
    w = Warehouse.over_benchmark_tables(spark, SF_DIR, workspace)
    assert not w.raw_applications.isEmpty()
    assert os.path.exists(workspace.path("raw", "applications")) and not os.path.exists(workspace.path("raw", "studies"))
    assert not w.raw_studies.isEmpty() and os.path.exists(workspace.path("raw", "studies"))


def test_documents_are_gathered_by_tasks_of_a_bounded_number_of_lines(spark, monkeypatch):
    builds = (benchmark_tables.raw_studies, benchmark_tables.raw_applications)
    expected = [rows(build(spark, SF_DIR)) for build in builds]
    monkeypatch.setattr(benchmark_tables, "LINES_A_TASK", 200)
    lines = benchmark_tables.read_table(spark, SF_DIR, "lineitem").count()
    for build, same in zip(builds, expected, strict=True):
        frame = build(spark, SF_DIR)
        plan = frame._jdf.queryExecution().executedPlan().toString()
        # Line items are shuffled once, by key and document.
        assert plan.count("REPARTITION_BY_NUM") == 1 and f", {-(-lines // 200)}), REPARTITION_BY_NUM" in plan
        assert rows(frame) == same


def test_line_items_are_shuffled_before_their_texts_are_built(spark):
    plan = benchmark_tables.raw_studies(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    above, _, below = plan.partition("RepartitionByExpression")
    assert "Outcome " in above and below and "Outcome " not in below


def small_tables(spark, folder: str, suppliers: list, parts: list, lines: list) -> str:
    """One order and one customer with these suppliers, parts and line items (supplier, part, number)."""
    day = "timestamp'1995-03-04' as"
    frames = {
        "customer": spark.createDataFrame([(1, "C", "BUILDING")], "c_custkey long, c_name string, c_mktsegment string"),
        "orders": spark.range(1).selectExpr(
            "1L as o_orderkey", "1L as o_custkey", "'F' as o_orderstatus", "1e5 as o_totalprice", f"{day} o_orderdate", "'1-URGENT' as o_orderpriority"
        ),
        "supplier": spark.createDataFrame(suppliers, "s_suppkey long, s_name string"),
        "part": spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "lineitem": spark.createDataFrame(lines, "l_suppkey long, l_partkey long, l_linenumber int").selectExpr(
            "1L as l_orderkey", "*", f"{day} l_shipdate", "'F' as l_linestatus", "'N' as l_returnflag"
        ),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_line_items_are_shuffled_without_what_is_looked_up_for_documents(spark):
    plan = benchmark_tables.raw_applications(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    above, _, below = plan.partition("RepartitionByExpression")
    shuffled, names, _ = below.partition("Aggregate [s_suppkey")
    assert "s_name" in above and names and "s_name" not in shuffled and "cast(l_shipdate" in shuffled


def test_line_items_are_counted_without_a_lookup_of_unique_keys(spark, tmp_path):
    """Both shuffled by the key of a large lookup table otherwise, once to be counted."""
    parts = [(1, "a", "B", "T", 1), (2, "b", "B", "T", 2), (None, "c", "B", "T", 3), (None, "d", "B", "T", 3)]
    given = {"once": parts, "twice": [*parts, parts[0]]}
    for name, outcomes in (("once", 3), ("twice", 4)):
        folder = small_tables(spark, str(tmp_path / name), [(1, "S")], given[name], [(1, 1, 1), (1, 2, 2), (1, None, 3)])
        raw = benchmark_tables.raw_studies(spark, folder)
        scans = raw._jdf.queryExecution().executedPlan().toString().count("ReadSchema: struct<p_partkey")
        assert (scans == 1) == (name == "once")
        assert documents.study_columns(raw, "num_primary_outcomes").collect()[0][-1] == outcomes


def test_a_supplier_or_part_listed_twice_counts_its_line_items_twice(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(benchmark_tables, "LINES", 2)
    suppliers = [(1, "A"), (1, "A"), (2, "B"), (2, None), (3, "C"), (None, "D")]
    lines = [(1, 1, 1), (2, 1, 2), (3, 1, 3), (4, 1, 4), (None, 1, 5), (3, None, 6)]
    folder = small_tables(spark, str(tmp_path), suppliers, [(1, "a", "B", "T", 1), (99, "x", "B", "T", 1)], lines)
    parsed = documents.parse_applications(benchmark_tables.raw_applications(spark, folder))
    found = parsed.selectExpr("application_number", "trim(sponsor_name)", "transform(submissions, s -> s.submission_number)")
    assert rows(found) == [
        ("1", None, ["1-5"]), ("1-1", "A", ["1-1", "1-1"]), ("2-1", "B", ["1-2"]), ("2-1", None, ["1-2"]),
        ("3", "C", ["1-6"]), ("3-1", "C", ["1-3"]), ("4-1", None, ["1-4"]),
    ]


def test_rules_read_row_local_models_that_are_not_written(make_warehouse, workspace):
    w = make_warehouse([study("A", sponsor="s", conditions=["x", "y"], interventions=[{"name": "i", "type": "DRUG"}]), study("B", conditions=["x"])])
    written = ("bridge_trial_condition", "bridge_trial_intervention", "fct_trials")
    found = rows(QUERIES["dq_relationships"](w))
    assert not any(os.path.exists(workspace.path("marts", name)) for name in written)
    assert os.path.exists(workspace.path("marts", "dim_condition"))
    for name in written:
        w.table(name)
        assert os.path.exists(workspace.path("marts", name)) and w.rows_of(name) is w.table(name)
    assert rows(QUERIES["dq_relationships"](w)) == found and ("bridge_trial_condition", "condition_key", "relationships", 0) in found


def test_fields_of_studies_are_taken_by_path(spark, make_warehouse):
    """A field of another type, or below one, is null; the others are kept, as out of one struct of all."""
    given = [
        ("N1", '{"protocolSection": {"identificationModule": {"briefTitle": 7}, "statusModule": [1], "conditionsModule": {"conditions": "x"}}, "hasResults": "true"}'),
        ("N2", '{"protocolSection": {"conditionsModule": {"conditions": [" a ", 5, null, {"b": 1}]}, "outcomesModule": {"primaryOutcomes": [{}, null, [1]]}, "armsInterventionsModule": {"interventions": [{"name": "i"}, "j", null]}}}'),
        ("N3", '{"protocolSection": "none", "hasResults": null}'),
        ("N4", "{}"),
        ("N5", "[]"),
    ]
    w = make_warehouse(given)
    plan = w.plan("studies_parsed")
    assert "$.protocolSection.statusModule.whyStopped" in plan._jdf.queryExecution().optimizedPlan().toString()
    expected = documents.study_columns(w.raw_studies, *documents.STUDY_COLUMNS).drop("source_fetched_at")
    assert rows(plan.select(*expected.columns)) == rows(expected) and expected.count() == 4


def test_a_large_bucket_is_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "ROWS_A_TASK", 20)
    store = KeyedStore(spark, str(tmp_path / "store"), "k", StructType.fromDDL("k string, v string, at bigint"), buckets=2)
    given = [(f"k{n}", "old", 1) for n in range(400)]
    store.merge(spark.createDataFrame(given, store.schema), ("at",))
    assert len(parts(store.folder)) > 8
    store.merge(spark.createDataFrame([("k7", "late", 0), ("k7", "new", 2), ("k7", "newer", 3)], store.schema), ("at",))
    assert rows(store.read()) == sorted([r for r in given if r[0] != "k7"] + [("k7", "newer", 3)])
    store.replace(spark.createDataFrame([("k8",), ("k9",)], "k string"), spark.createDataFrame([("k8", "a", 1), ("k8", "b", 1)], store.schema))
    assert rows(store.read().where("k in ('k8', 'k9')")) == [("k8", "a", 1), ("k8", "b", 1)] and store.read().count() == 400


def test_changed_records_are_read_where_the_source_has_them(spark, tmp_path, monkeypatch):
    studies, applications = (record_store(spark, str(tmp_path / name), 2) for name in ("studies", "applications"))
    given = [study(f"N{n}", conditions=["Flu", "Cold"]) for n in range(5)]
    raw = spark.createDataFrame(given, "record_id string, payload string").selectExpr(
        "record_id", "payload", "current_timestamp() as fetched_at", "0L as batch_id", "0L as page", "0 as pos"
    )
    studies.merge(raw, ORDER)
    written, write = [], Workspace.write_fresh
    monkeypatch.setattr(Workspace, "write_fresh", lambda self, frame, name: written.append((name, frame.columns)) or write(self, frame, name))
    live = LiveMarts(spark, str(tmp_path / "live"), studies, applications, 2)
    live.refresh()
    assert not any("payload" in columns or "after" in columns for _, columns in written)
    assert "bridge_key" not in live.stores["bridge_trial_condition"].read().columns
    assert live.bridge_trial_condition.select("bridge_key").distinct().count() == 10
