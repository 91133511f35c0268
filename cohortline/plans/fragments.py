"""Single operators applied to the registry tables, one small query for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline import functions as fn
from cohortline import operators as op
from cohortline.keyed import KeyedStore
from cohortline.operators.dedupe import ARRIVAL
from cohortline.plans import dashboards, exports, insights, marts, metrics, quality, serving, staging
from cohortline.sinks.csv import write_csv
from cohortline.sinks.layers import append_audit, publish_staging, read_audit
from cohortline.sinks.published import open_run, publish_run
from cohortline.sources import pages
from cohortline.sources.benchmark_tables import event_pages, event_records
from cohortline.sources.documents import nested_schema, parsed, study_columns
from cohortline.sources.live import live_marts
from cohortline.streaming import ingest as streams
from cohortline.warehouse import Warehouse

# Sources, ingest and sinks


def src_raw_studies(w: Warehouse) -> DataFrame:
    path = "protocolSection.identificationModule.nctId"
    documents = parsed(w.raw_studies, nested_schema([path], {}))
    return documents.select("nct_id", "fetched_at", F.col(f"doc.{path}").alias("document_key"))


def src_raw_applications(w: Warehouse) -> DataFrame:
    documents = parsed(w.raw_applications, "application_number string")
    return documents.select("application_number", "fetched_at", F.col("doc.application_number").alias("document_key"))


def ingest_page_unpack(w: Warehouse) -> DataFrame:
    records = pages.unpack_pages(event_pages(w.spark, w.sf_dir), "studies")
    return records.select(
        "page", F.col("pos").cast("bigint").alias("pos"), F.get_json_object("payload", "$.user").alias("record_id")
    )


def ingest_record_key(w: Warehouse) -> DataFrame:
    def keys(raw: DataFrame, source: pages.Source) -> DataFrame:
        return raw.select(
            F.lit(source.name).alias("source"), pages.record_key(F.col("payload"), source.key_path).alias("record_id")
        )

    return keys(w.raw_studies, pages.STUDIES).unionByName(keys(w.raw_applications, pages.APPLICATIONS))


def ingest_keyset_filter(w: Warehouse) -> DataFrame:
    return pages.after_key(w.raw_applications.select("application_number", "fetched_at"), "application_number", "5")


def ingest_upsert(w: Warehouse) -> DataFrame:
    """Two deliveries merged into the keyed store one after the other."""
    records = event_records(w.spark, w.sf_dir)
    late = F.pmod("page", F.lit(2)) == 1
    store = KeyedStore(w.spark, w.workspace.fresh("keyed"), "record_id", records.schema, buckets=8)
    store.merge(records.where(~late), ARRIVAL)
    store.merge(records.where(late), ARRIVAL)
    return store.read()


def ingest_incremental(w: Warehouse) -> DataFrame:
    landing, log = w.workspace.fresh("landing"), w.workspace.fresh("log")
    streams.land(event_pages(w.spark, w.sf_dir), landing)
    streams.ingest(w.spark, landing, log, w.workspace.fresh("stream"), "studies", "user")
    store = streams.record_store(w.spark, w.workspace.fresh("records"), buckets=8)
    streams.merge_log(w.spark, log, store)
    return store.read().select(
        "record_id",
        F.get_json_object("payload", "$.event_id").cast("bigint").alias("event_id"),
        "fetched_at",
        "page",
        F.col("pos").cast("bigint").alias("pos"),
    )


def gate_raw_nonempty(w: Warehouse) -> DataFrame:
    return quality.nonempty(w.table)


def source_freshness(w: Warehouse) -> DataFrame:
    return quality.freshness(w.table, F.lit("2001-11-05 00:00:00").cast("timestamp"))


def audit_exclusions(w: Warehouse) -> DataFrame:
    log = w.workspace.fresh("audit")
    append_audit(staging.excluded_applications(w.applications_parsed), log)
    return read_audit(w.spark, log).drop("log_id", "logged_at")


def sink_view(w: Warehouse) -> DataFrame:
    publish_staging(w)
    return serving.run_query(
        w.spark, "SELECT overall_status, count(*) AS trial_count FROM staging.stg_trials GROUP BY overall_status"
    )


def sink_table(w: Warehouse) -> DataFrame:
    """All tables published at once, one read from the run that the manifest names."""
    folder = w.workspace.fresh("published")
    publish_run(w, folder, 0)
    return open_run(w.spark, folder).sql("SELECT phase, count(*) AS trial_count FROM {fct_trials} GROUP BY phase")


def serve_answer(w: Warehouse) -> DataFrame:
    """The kept answer to a statement over the published tables, from its second reading on."""
    folder = w.workspace.fresh("published")
    publish_run(w, folder, 0)
    statement = "SELECT overall_status, count(*) AS trial_count FROM {fct_trials} WHERE phase IS NOT NULL GROUP BY overall_status"
    open_run(w.spark, folder).answer(statement)
    return open_run(w.spark, folder).answer(statement)


# Tables kept up to date from changes


def live_fct_trials(w: Warehouse) -> DataFrame:
    return live_marts(w).fct_trials


def live_bridge_trial_condition(w: Warehouse) -> DataFrame:
    return live_marts(w).bridge_trial_condition


def live_condition_funnel(w: Warehouse) -> DataFrame:
    return live_marts(w).condition_funnel.drop("trial_count", "multi_condition_trials", "matched_trials")


def live_metric_phase_transition(w: Warehouse) -> DataFrame:
    return live_marts(w).metric_phase_transition


def sink_csv(w: Warehouse) -> DataFrame:
    frame, folder = exports.export_sponsor_league_table(w.dim_sponsor), w.workspace.fresh("csv")
    write_csv(frame, folder)
    return w.spark.read.option("header", True).schema(frame.schema).csv(folder)


# Projections and filters


def proj_json_path(w: Warehouse) -> DataFrame:
    return study_columns(w.raw_studies, "brief_title", "overall_status").drop("source_fetched_at")


def proj_json_cast(w: Warehouse) -> DataFrame:
    return study_columns(w.raw_studies, "enrollment_count", "has_results").drop("source_fetched_at")


def proj_null_if_blank(w: Warehouse) -> DataFrame:
    return study_columns(w.raw_studies, "sponsor_name", "sponsor_class", "why_stopped").drop("source_fetched_at")


def proj_rename(w: Warehouse) -> DataFrame:
    return marts.fct_approvals(w.stg_approvals).select("approval_key", "approval_date")


def proj_typed_null(w: Warehouse) -> DataFrame:
    return w.dim_condition.select("condition_key", "mesh_term", "therapeutic_area")


def proj_constant(w: Warehouse) -> DataFrame:
    return w.fct_trials.select("nct_id", F.lit(True).alias("grouping_by_condition_name"))


def proj_compare_flag(w: Warehouse) -> DataFrame:
    return w.stg_trials.select("nct_id", (F.col("overall_status") == "TERMINATED").alias("is_terminated"))


def proj_default(w: Warehouse) -> DataFrame:
    return w.stg_trials.select(
        "nct_id",
        fn.fill_missing(F.col("phase"), "NOT REPORTED").alias("phase"),
        fn.fill_missing(F.col("sponsor_class"), "UNKNOWN").alias("sponsor_class"),
    )


def filt_not_null(w: Warehouse) -> DataFrame:
    return w.stg_trials.where(F.col("sponsor_name").isNotNull()).select("nct_id", "sponsor_name")


def filt_null(w: Warehouse) -> DataFrame:
    return w.fct_trials.where(F.col("completion_date").isNull()).select("nct_id")


def filt_threshold(w: Warehouse) -> DataFrame:
    return serving.phase_funnel_by_condition(w.condition_funnel, dashboards.FUNNEL_MIN_PHASE2)


def filt_between(w: Warehouse) -> DataFrame:
    return w.metric_duration_trends.where(F.col("start_year").between(2000, 2010)).select("start_year", "trial_count")


def filt_in_list(w: Warehouse) -> DataFrame:
    return w.dim_sponsor.where(F.col("sponsor_class").isin("INDUSTRY", "NIH")).select("sponsor_name", "sponsor_class")


def filt_bool(w: Warehouse) -> DataFrame:
    return w.fct_trials.where("is_terminated").select("nct_id", "why_stopped")


def filt_cutoff_split(w: Warehouse) -> DataFrame:
    return op.split_at(w.metric_duration_trends.select("start_year", "trial_count"), "start_year", 2017)


# Joins and unnesting


def join_inner_using(w: Warehouse) -> DataFrame:
    return op.lookup(w.stg_trial_conditions, w.dim_condition, "condition_name", "inner").select(
        "nct_id", "condition_key"
    )


def join_inner_multi(w: Warehouse) -> DataFrame:
    return op.lookup(
        w.stg_trial_interventions, w.dim_intervention, ["intervention_name", "intervention_type"], "inner"
    ).select("nct_id", "intervention_key")


def join_left_using(w: Warehouse) -> DataFrame:
    return op.lookup(w.fct_trials, w.dim_sponsor, "sponsor_key").select("nct_id", "sponsor_name", "sponsor_class")


def join_left_on(w: Warehouse) -> DataFrame:
    return op.lookup(w.stg_trials, w.dim_sponsor.select("sponsor_name", "sponsor_key"), "sponsor_name").select(
        "nct_id", "sponsor_key"
    )


def join_normalized_name(w: Warehouse) -> DataFrame:
    return op.match_by_name(w.dim_sponsor, w.fda_sponsors, "sponsor_name", "sponsor_name_norm").select(
        "sponsor_name",
        F.col("matched").alias("matched_to_fda"),
        "fda_application_count",
    )


def join_one_row_concat(w: Warehouse) -> DataFrame:
    ends = w.fct_trials.agg(fn.rate(F.col("completion_date").isNull()).alias("completion_date_null_rate"))
    areas = w.dim_condition.agg(fn.rate(F.col("therapeutic_area").isNull()).alias("therapeutic_area_null_rate"))
    return op.one_row(areas, ends)


def join_anti_relationship(w: Warehouse) -> DataFrame:
    return op.orphans(w.fct_approvals, "sponsor_name", w.dim_sponsor.select("sponsor_name"), "sponsor_name")


def unnest_scalar_array(w: Warehouse) -> DataFrame:
    return op.unnest(w.studies_parsed, "conditions", "nct_id", condition_name=None)


def unnest_object_array(w: Warehouse) -> DataFrame:
    return w.applications_parsed.select("application_number", F.inline("submissions")).select(
        "application_number", "submission_type", "submission_number"
    )


def unnest_year_range(w: Warehouse) -> DataFrame:
    first = F.year("start_date")
    years = fn.year_span(first, F.coalesce(F.year("completion_date"), first))
    return w.fct_trials.where("start_date is not null and sponsor_key is not null").select(
        "sponsor_key", "nct_id", F.explode(years).alias("activity_year")
    )


# Aggregations


def agg_count(w: Warehouse) -> DataFrame:
    return w.stg_trials.groupBy("overall_status").agg(fn.row_count().alias("trial_count"))


def agg_count_filter(w: Warehouse) -> DataFrame:
    return w.stg_trials.groupBy("sponsor_class").agg(
        fn.row_count().alias("trials_total"), F.count_if(F.col("overall_status") == "COMPLETED").alias("trials_completed")
    )


def agg_filtered_ratio(w: Warehouse) -> DataFrame:
    done = F.count_if(F.col("overall_status") == "COMPLETED")
    return w.stg_trials.groupBy("phase").agg(fn.ratio(done, fn.row_count()).alias("completed_rate"))


def agg_count_distinct(w: Warehouse) -> DataFrame:
    return w.fct_trials.groupBy(F.year("start_date").alias("start_year")).agg(
        F.count_distinct("sponsor_key").alias("sponsors")
    )


def agg_count_distinct_filter(w: Warehouse) -> DataFrame:
    over = F.when(F.col("phase3_to_approval_rate") > 1, F.col("condition_name"))
    return w.metric_phase_transition.where("condition_phase3_trials >= 5").agg(
        F.count_distinct(over).alias("over_count"), F.count_distinct("condition_name").alias("total_count")
    )


def agg_sum_avg(w: Warehouse) -> DataFrame:
    mean = F.sum(F.col("success_rate").cast("decimal(5,4)")) / fn.row_count()
    return w.dim_sponsor.groupBy("sponsor_class").agg(
        F.sum("trials_total").alias("total_trials"), F.round(mean, 4).cast("double").alias("avg_success_rate")
    )


def agg_min_date(w: Warehouse) -> DataFrame:
    firsts = w.fct_trials.where("start_date is not null and sponsor_key is not null").groupBy("sponsor_key").agg(
        F.min("start_date").alias("first_trial_date")
    )
    return firsts.withColumn("cohort_year", F.year("first_trial_date"))


def agg_min_filter(w: Warehouse) -> DataFrame:
    return w.fct_approvals.groupBy("application_number").agg(
        F.min(F.when(F.col("submission_status") == "AP", F.col("approval_date"))).alias("first_approval_date")
    )


def agg_max(w: Warehouse) -> DataFrame:
    return w.metric_phase_transition.groupBy("condition_name").agg(
        F.max("condition_phase2_trials").alias("phase2_trials"),
        F.max("phase2_to_phase3_rate").alias("phase2_to_phase3_rate"),
    )


def agg_bool_or(w: Warehouse) -> DataFrame:
    return w.fct_approvals.groupBy("application_number").agg(
        F.bool_or(F.col("submission_status") == "AP").alias("is_approved")
    )


def agg_bool_and(w: Warehouse) -> DataFrame:
    return w.fct_approvals.groupBy("application_number").agg(
        F.bool_and(F.col("submission_status") == "AP").alias("all_approved")
    )


def agg_bool_rate(w: Warehouse) -> DataFrame:
    return w.fct_trials.groupBy("phase").agg(
        fn.rate(F.col("has_results")).alias("results_rate"),
        fn.rate(F.col("completion_date").isNull()).alias("completion_date_null_rate"),
    )


def agg_percentile_cont(w: Warehouse) -> DataFrame:
    return op.percentile_bands(w.duration_histogram, ["start_year"], "duration_days", metrics.BANDS)


def agg_mode_tiebreak(w: Warehouse) -> DataFrame:
    return staging.stg_sponsors(w.stg_trials)


def agg_regrain(w: Warehouse) -> DataFrame:
    applications = op.approval_by_application(w.fct_approvals).where("sponsor_name is not null")
    return applications.groupBy(fn.normalized_name(F.col("sponsor_name")).alias("sponsor_name_norm")).agg(
        F.count_distinct("application_number").alias("application_count"),
        F.bool_or("is_approved").alias("has_fda_approval"),
    )


def agg_pandas_regroup(w: Warehouse) -> DataFrame:
    return exports.export_phase_distribution(w.fct_trials)


def agg_portfolio_ratio(w: Warehouse) -> DataFrame:
    return insights.kpi_portfolio_phase2_to_approval(w.condition_funnel)


def distinct_rows(w: Warehouse) -> DataFrame:
    return w.stg_trial_conditions.select("condition_name").distinct()


# Windows


def win_row_number_first(w: Warehouse) -> DataFrame:
    return op.first_per_group(w.bridge_trial_condition, "nct_id", F.col("condition_key")).select(
        "nct_id", "condition_key"
    )


def win_row_number_over_agg(w: Warehouse) -> DataFrame:
    counts = w.stg_trials.where("sponsor_name is not null").groupBy("sponsor_name", "sponsor_class").agg(
        fn.row_count().alias("n")
    )
    order = Window.partitionBy("sponsor_name").orderBy(F.col("n").desc(), F.col("sponsor_class").asc_nulls_last())
    return counts.withColumn("place", F.row_number().over(order).cast("bigint"))


def win_partition_count(w: Warehouse) -> DataFrame:
    # A trial's conditions are those of one document, so a partition is bounded by it.
    per_trial = fn.row_count().over(Window.partitionBy("nct_id"))
    return w.bridge_trial_condition.select("bridge_key", (per_trial > 1).alias("multi_condition_flag"))


def win_partition_sum(w: Warehouse) -> DataFrame:
    totals = op.per_group_totals(
        w.trial_funnel,
        "condition_name",
        condition_phase2_trials=F.count_if("is_phase2"),
        condition_phase3_trials=F.count_if("is_phase3"),
    )
    return totals.select("nct_id", "condition_phase2_trials", "condition_phase3_trials")


def win_ratio(w: Warehouse) -> DataFrame:
    two, three, approved = (
        F.col(f"condition_{stage}_trials") for stage in ("phase2", "phase3", "approved")
    )
    return w.metric_phase_transition.select(
        "nct_id",
        fn.ratio(three, two).alias("phase2_to_phase3_rate"),
        fn.ratio(approved, three).alias("phase3_to_approval_rate"),
        fn.ratio(approved, two).alias("phase2_to_approval_rate"),
    )


def win_lag_global(w: Warehouse) -> DataFrame:
    return op.add_lag(
        w.metric_duration_trends.select("start_year", "trial_count"), "prior_count", "trial_count", "start_year"
    )


def win_lag_partition(w: Warehouse) -> DataFrame:
    counts = w.metric_duration_trends_by_phase.select("start_year", "phase", "trial_count")
    return op.add_lag(counts, "prior_count", "trial_count", "start_year", "phase")


def win_yoy(w: Warehouse) -> DataFrame:
    return metrics.metric_duration_trends(w.duration_histogram).select("start_year", "yoy_change_days", "yoy_change_pct")


def win_first_value(w: Warehouse) -> DataFrame:
    counts = w.metric_sponsor_cohorts.select("cohort_year", "activity_year", "active_sponsor_count")
    return op.add_launch_value(counts, "launch_count", "active_sponsor_count", "cohort_year", "activity_year")


def win_share_of_total(w: Warehouse) -> DataFrame:
    return dashboards.phase_share_by_year(w.fct_trials)


def win_rank_flag(w: Warehouse) -> DataFrame:
    return dashboards.league_ranked(w.dim_sponsor, w.workspace, ["INDUSTRY", "NIH", "FED"])


# Sorts, limits, distinct


def sort_multi(w: Warehouse) -> DataFrame:
    return w.metric_duration_trends_by_phase.select("phase", "start_year", "trial_count").orderBy(
        "phase", F.col("start_year").desc()
    )


def topk_limit(w: Warehouse) -> DataFrame:
    return serving.why_stopped_breakdown(w.fct_trials, 5)


def topk_members(w: Warehouse) -> DataFrame:
    series = serving.approvals_per_year(w.applicant_years, "sponsor_name", "UNKNOWN")
    return op.rows_of_top_members(series, "sponsor_name", "approval_count", 3)


def topk_nlargest(w: Warehouse) -> DataFrame:
    return dashboards.funnel_top_n(w.condition_funnel, 10).orderBy("condition_phase2_trials", "condition_name")


def set_distinct(w: Warehouse) -> DataFrame:
    return w.fct_trials.select("overall_status", "phase").distinct()


# Scalar functions


def fn_surrogate_key(w: Warehouse) -> DataFrame:
    return w.fct_trials.select("nct_id", fn.surrogate_key("nct_id", "phase", "duration_days").alias("trial_key"))


def fn_array_join_nullif(w: Warehouse) -> DataFrame:
    return study_columns(w.raw_studies, "phase").drop("source_fetched_at")


def fn_array_length(w: Warehouse) -> DataFrame:
    return study_columns(w.raw_studies, "num_primary_outcomes", "num_sites").drop("source_fetched_at")


def fn_partial_date(w: Warehouse) -> DataFrame:
    return study_columns(w.raw_studies, "start_date", "completion_date").drop("source_fetched_at")


def _submission_dates(w: Warehouse) -> DataFrame:
    fields = "submission_type: string, submission_number: string, submission_status_date: string"
    doc = parsed(w.raw_applications, f"submissions array<struct<{fields}>>")
    return doc.select("application_number", F.explode("doc.submissions").alias("s")).select(
        "application_number", "s.submission_type", "s.submission_number", "s.submission_status_date"
    )


def fn_compact_date(w: Warehouse) -> DataFrame:
    return _submission_dates(w).withColumn(
        "submission_status_date", fn.compact_date(F.col("submission_status_date"))
    )


def fn_regex_match(w: Warehouse) -> DataFrame:
    text = F.col("submission_status_date")
    return _submission_dates(w).select(
        "application_number", "submission_type", "submission_number", text.rlike(r"^\d{8}$").alias("is_compact")
    )


def fn_date_diff(w: Warehouse) -> DataFrame:
    return w.stg_trials.select(
        "nct_id", fn.days_between(F.col("start_date"), F.col("completion_date")).alias("duration_days")
    )


def fn_year(w: Warehouse) -> DataFrame:
    return w.fct_trials.select("nct_id", F.year("start_date").alias("start_year"))


def fn_round_ratio(w: Warehouse) -> DataFrame:
    return w.dim_sponsor.select(
        "sponsor_name", fn.ratio(F.col("trials_completed"), F.col("trials_total")).alias("success_rate")
    )


def fn_norm_name(w: Warehouse) -> DataFrame:
    return w.fct_approvals.select("approval_key", fn.normalized_name(F.col("sponsor_name")).alias("sponsor_name_norm"))


def fn_ilike(w: Warehouse) -> DataFrame:
    return w.fct_trials.select(
        "nct_id",
        fn.is_combined_phase(F.col("phase"), "PHASE2").alias("is_phase2"),
        fn.is_combined_phase(F.col("phase"), "PHASE3").alias("is_phase3"),
    )


def fn_case(w: Warehouse) -> DataFrame:
    return w.trial_funnel.select("nct_id", F.when(F.col("is_phase2"), 1).otherwise(0).alias("phase2_flag"))


def fn_decode_class(w: Warehouse) -> DataFrame:
    return w.stg_trials.select("nct_id", fn.decode_sponsor_class(F.col("sponsor_class")).alias("class_label"))


def fn_decode_phase(w: Warehouse) -> DataFrame:
    return w.stg_trials.select("nct_id", fn.decode_phase(F.col("phase")).alias("phase_label"))


def fn_fill_missing(w: Warehouse) -> DataFrame:
    return w.fct_trials.select("nct_id", fn.fill_missing(F.col("why_stopped"), "Not Reported").alias("why_stopped"))


def fn_traffic_light(w: Warehouse) -> DataFrame:
    light = fn.traffic_light(F.col("success_rate"), dashboards.GOOD_MAX, dashboards.WARNING_MAX)
    return w.dim_sponsor.select("sponsor_name", light.alias("light"))


def fn_rate_round(w: Warehouse) -> DataFrame:
    return fn.round_rates(exports.export_phase_funnel(w.condition_funnel))
