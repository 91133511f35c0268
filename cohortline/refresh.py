"""One full load: raw tables in, published tables, rules checked and CSV exports out."""

from __future__ import annotations

import time
import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame

from cohortline.plans import quality, staging
from cohortline.sinks.csv import export_all
from cohortline.sinks.layers import append_audit, publish_staging, publish_tables, register_views
from cohortline.sinks.published import forget_runs, manifests, publish_run
from cohortline.sources.documents import unreadable
from cohortline.warehouse import LAYERS, MODELS, RAW, Warehouse
from cohortline.workspace import Workspace


def check_models(w: Warehouse, models: list[str], stopped: Collection[str] = ()) -> None:
    """Raise if a rule on one of these models has failures; rules against stopped models are left out."""
    checks = (
        (quality.not_null, {m: c for m, c in quality.NOT_NULL.items() if m in models}),
        (quality.unique, {m: c for m, c in quality.UNIQUE.items() if m in models}),
        (quality.accepted_values, {m: c for m, c in quality.ACCEPTED.items() if m in models}),
        (quality.relationships, [rule for rule in quality.RELATIONSHIPS if rule[0] in models and rule[2] not in stopped]),
    )
    for check, rules in checks:
        if rules:
            quality.require_clean(check(w.table, rules))


def refresh(
    raw_studies: DataFrame,
    raw_applications: DataFrame,
    folder: str,
    strict: bool = True,
    partial: bool = False,
    keep_runs: int = 2,
    copy_raw: bool = True,
) -> Warehouse:
    """Rebuild all layers in a folder of this run below ``folder/runs``, check them, then publish.

    Nothing that is published changes before the rules have been checked: tables, views
    and exports keep showing the former run. A model that breaks a rule stops those that
    read it; other branches are built and checked on. If any rule is broken the run raises
    at the end, having published nothing, or with ``partial`` the branches that passed
    (without exports). All tables are switched by one manifest (``sinks.published``), which
    fails with ``manifest.Conflict`` if another run has published meanwhile; tables of the
    catalog, views and exports follow it. ``strict=False`` skips the rules. Runs beyond the newest
    ``keep_runs`` are deleted after publishing. ``copy_raw=False`` reads stored raw
    tables in place, as the jobs do with their snapshots.
    """
    spark = raw_studies.sparkSession
    since = manifests(spark, folder).newest()[0]
    run = f"{time.time_ns() // 1_000_000:014d}-{uuid.uuid4().hex[:6]}"
    workspace = Workspace(spark, f"{folder}/runs/{run}")
    if copy_raw:
        raw_studies = workspace.write(raw_studies, "raw", "studies")
        raw_applications = workspace.write(raw_applications, "raw", "applications")
    w = Warehouse(raw_studies, raw_applications, workspace)
    quality.require_nonempty(w.table)
    failures: list[str] = []
    stopped: set[str] = set()

    def passes(name: str) -> bool:
        if strict:
            try:
                check_models(w, [name], stopped)
            except quality.QualityError as error:
                failures.append(str(error))
                return False
        return True

    def stop(name: str) -> None:
        """The model and, models being listed after what they read, all that depend on it."""
        stopped.add(name)
        for other, model in MODELS.items():
            if stopped.intersection(model.inputs):
                stopped.add(other)

    for name in RAW:
        if not passes(name):
            stop(name)
    for name, model in MODELS.items():
        if name not in stopped:
            w.table(name)
            if model.layer in LAYERS and not passes(name):
                stop(name)
    if failures and not partial:
        raise quality.QualityError("; ".join(failures))

    passed = set(MODELS) - stopped
    publish_run(w, folder, since, passed)
    log = f"{folder}/ops/extraction_log"
    append_audit(staging.excluded_documents(unreadable(w.raw_studies), "stg_trials"), log)
    append_audit(staging.excluded_documents(unreadable(w.raw_applications), "stg_approvals"), log)
    if "applications_parsed" in passed:
        append_audit(staging.excluded_applications(w.applications_parsed), log)
    register_views(w, passed)
    publish_staging(w, passed)
    for layer in ("marts", "metrics"):
        publish_tables(w, layer, passed)
    if failures:
        raise quality.QualityError("; ".join(failures))
    export_all(w, f"{folder}/exports")
    forget_runs(spark, folder, keep_runs)
    return w
