"""Jobs for spark-submit: take in landed pages, rebuild the tables, write the exports.

    python -m cohortline ingest --source studies --landing DIR --log DIR --checkpoint DIR
    python -m cohortline refresh --studies-log DIR --applications-log DIR --target DIR
"""

from __future__ import annotations

import argparse

from cohortline.refresh import refresh
from cohortline.session import build_session
from cohortline.sources.pages import APPLICATIONS, STUDIES
from cohortline.streaming.ingest import ingest, merge_log, raw_table, record_store, trim_log

SOURCES = {source.name: source for source in (STUDIES, APPLICATIONS)}


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="cohortline")
    jobs = root.add_subparsers(dest="job", required=True)
    take = jobs.add_parser("ingest", help="add newly landed pages of one source to its log")
    take.add_argument("--source", choices=sorted(SOURCES), required=True)
    for name in ("landing", "log", "checkpoint"):
        take.add_argument(f"--{name}", required=True)
    take.add_argument("--files-per-batch", type=int, default=1000)
    take.add_argument("--rejects", choices=("keep", "fail"), default="keep")
    build = jobs.add_parser("refresh", help="rebuild, check, publish and export all tables")
    for name in ("studies-log", "applications-log", "target"):
        build.add_argument(f"--{name}", required=True)
    build.add_argument("--skip-rules", action="store_true")
    build.add_argument("--partial", action="store_true", help="publish the branches that pass their rules")
    build.add_argument("--keep-runs", type=int, default=2)
    build.add_argument("--trim-logs", action="store_true", help="delete the batches that the record stores hold")
    return root


def main(arguments: list[str] | None = None) -> None:
    options = parser().parse_args(arguments)
    spark = build_session(f"cohortline {options.job}")
    if options.job == "ingest":
        source = SOURCES[options.source]
        ingest(
            spark,
            options.landing,
            options.log,
            options.checkpoint,
            source.list_field,
            source.key_path,
            options.files_per_batch,
            options.rejects,
        )
        return
    # New batches are merged into the store of their source, whose records are the raw table.
    logs = {STUDIES: options.studies_log, APPLICATIONS: options.applications_log}
    stores = {source: record_store(spark, f"{options.target}/records/{source.name}") for source in logs}
    for source, log in logs.items():
        merge_log(spark, log, stores[source])
    tables = {source: raw_table(store.read(), source.key_name) for source, store in stores.items()}
    refresh(
        tables[STUDIES],
        tables[APPLICATIONS],
        options.target,
        strict=not options.skip_rules,
        partial=options.partial,
        keep_runs=options.keep_runs,
        copy_raw=False,
    )
    for source, store in stores.items():
        store.vacuum(options.keep_runs)
        if options.trim_logs:
            trim_log(spark, logs[source], store)


if __name__ == "__main__":
    main()
