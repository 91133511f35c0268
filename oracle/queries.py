"""One SQL statement per query name."""

from __future__ import annotations

from cohortline.functions.labels import PHASE_LABELS, SPONSOR_CLASS_LABELS
from cohortline.plans import quality
from oracle.tables import key, ratio, share, with_tables

FUNNEL = """condition_name, condition_phase2_trials, condition_phase3_trials, condition_approved_trials,
  phase2_to_phase3_rate, phase3_to_approval_rate, phase2_to_approval_rate"""
LEAGUE = "sponsor_name, sponsor_class, trials_total, trials_completed, success_rate"
TREND = """start_year, trial_count, p25_duration_days, median_duration_days, p75_duration_days,
  yoy_change_days, yoy_change_pct"""
TREND_BY_PHASE = """start_year, phase, trial_count, p25_duration_days, median_duration_days, p75_duration_days,
  yoy_change_days"""
CURVE = """cohort_year, activity_year, years_since_cohort, active_sponsor_count, cohort_launch_sponsor_count,
  survivorship_rate"""
LATEST = """qualify row_number() over (partition by record_id order by fetched_at desc, page desc, pos desc) = 1"""
MODELS = [
    "stg_trials",
    "stg_sponsors",
    "stg_trial_conditions",
    "stg_trial_interventions",
    "stg_approvals",
    "dim_sponsor",
    "dim_condition",
    "dim_intervention",
    "bridge_trial_condition",
    "bridge_trial_intervention",
    "fct_trials",
    "fct_approvals",
    "metric_phase_transition",
    "metric_sponsor_cohorts",
    "metric_duration_trends",
    "metric_duration_trends_by_phase",
]


def label(column: str, labels: dict[str, str]) -> str:
    cases = " ".join(f"when '{code}' then '{text}'" for code, text in labels.items())
    return f"case {column} {cases} else {column} end"


def class_label(column: str) -> str:
    return f"coalesce({label(column, SPONSOR_CLASS_LABELS)}, 'Unknown')"


def phase_label(column: str) -> str:
    parts = f"list_transform(string_split({column}, '|'), lambda p: {label('p', PHASE_LABELS)})"
    return f"coalesce(array_to_string({parts}, ' / '), 'Not Reported')"


def light(value: str) -> str:
    return f"case when {value} <= 0.15 then 'green' when {value} <= 0.35 then 'amber' else 'red' end"


def ranked(where: str = "true") -> str:
    place = "row_number() over (order by trials_total desc, sponsor_name)"
    return f"""select {place} as rank, if({place} <= 10, '🏆', '') as top_10, {LEAGUE}
      from dim_sponsor where {where}"""


def split_at_2017(series: str) -> str:
    return f"""select *, 'reliable' as segment from ({series}) where start_year <= 2017
      union all select *, 'censored' from ({series}) where start_year >= 2017"""


def segmented(columns: str, source: str, where: str = "true") -> str:
    return split_at_2017(f"select {columns} from {source} where {where}")


def rule(model: str, column: str, name: str, failures: str) -> str:
    return f"""select '{model}' as model, '{column}' as column_name, '{name}' as rule,
      cast(({failures}) as bigint) as failures"""


def literal(value) -> str:
    return str(value).lower() if isinstance(value, bool) else f"'{value}'"


def not_null_rules() -> str:
    return " union all ".join(
        rule(model, column, "not_null", f"select count(*) from {model} where {column} is null")
        for model, columns in quality.NOT_NULL.items()
        for column in columns
    )


def unique_rules() -> str:
    return " union all ".join(
        rule(
            model,
            column,
            "unique",
            f"select count(*) from (select {column} from {model} where {column} is not null group by all having count(*) > 1)",
        )
        for model, columns in quality.UNIQUE.items()
        for column in columns
    )


def accepted_rules() -> str:
    return " union all ".join(
        rule(
            model,
            column,
            "accepted_values",
            f"select count(*) from {model} where {column} not in ({', '.join(map(literal, values))})",
        )
        for model, lists in quality.ACCEPTED.items()
        for column, values in lists.items()
    )


def relationship_rules() -> str:
    return " union all ".join(
        rule(
            child,
            column,
            "relationships",
            f"""select count(*) from {child} c where c.{column} is not null
              and not exists (select 1 from {parent} p where p.{parent_key} = c.{column})""",
        )
        for child, column, parent, parent_key in quality.RELATIONSHIPS
    )


def _statements() -> dict[str, str]:
    terminated = "count(*) filter (is_terminated)"
    bands = """count(*) as trial_count, quantile_cont(duration_days, 0.25) as p25_duration_days,
      quantile_cont(duration_days, 0.5) as median_duration_days, quantile_cont(duration_days, 0.75) as p75_duration_days"""
    found = {name: f"select * from {name}" for name in MODELS}
    found |= {
        # Sources, ingest and sinks
        "src_raw_studies": "select nct_id, fetched_at, nct_id as document_key from raw_studies",
        "src_raw_applications": """select application_number, fetched_at, application_number as document_key
          from raw_applications""",
        "ingest_page_unpack": "select page, pos, record_id from records",
        "ingest_record_key": """select 'studies' as source, nct_id as record_id from raw_studies
          union all select 'applications', application_number from raw_applications""",
        "ingest_keyset_filter": "select * from raw_applications where application_number > '5'",
        "ingest_upsert": f"select * from records {LATEST}",
        "ingest_incremental": f"""select record_id, event_id, fetched_at, page, pos from (
          select * replace (max(fetched_at) over (partition by page) as fetched_at) from records)
          {LATEST}""",
        "gate_raw_nonempty": """select 'raw_studies' as source, (select count(*) from raw_studies) > 0 as has_rows
          union all select 'raw_applications', (select count(*) from raw_applications) > 0""",
        "source_freshness": """select source, age_hours,
            case when age_hours is null or age_hours > 50 then 'error' when age_hours > 26 then 'warn' else 'pass' end
              as status
          from (
            select source, date_diff('second', newest, timestamp '2001-11-05') / 3600e0 as age_hours from (
              select 'raw_studies' as source, max(fetched_at) as newest from raw_studies
              union all select 'raw_applications', max(fetched_at) from raw_applications))""",
        "audit_exclusions": """select 'stg_approvals' as model_name,
            'application has no submissions array (empty or null)' as exclusion_reason,
            count(*) as excluded_count
          from raw_applications r
          where not exists (select 1 from submissions s where s.application_number = r.application_number)""",
        "sink_view": "select overall_status, count(*) as trial_count from stg_trials group by all",
        "serve_answer": """select overall_status, count(*) as trial_count from fct_trials
          where phase is not null group by all""",
        "live_fct_trials": "select * from fct_trials",
        "live_bridge_trial_condition": "select * from bridge_trial_condition",
        "live_condition_funnel": """select distinct condition_name, condition_phase2_trials, condition_phase3_trials,
          condition_approved_trials, phase2_to_phase3_rate, phase3_to_approval_rate, phase2_to_approval_rate
          from metric_phase_transition""",
        "live_metric_phase_transition": "select * from metric_phase_transition",
        "sink_table": "select phase, count(*) as trial_count from fct_trials group by all",
        "sink_csv": f"""select * replace ({class_label("sponsor_class")} as sponsor_class)
          from (select {LEAGUE} from dim_sponsor)""",
        # Projections and filters
        "proj_json_path": "select nct_id, brief_title, overall_status from stg_trials",
        "proj_json_cast": "select nct_id, enrollment_count, has_results from stg_trials",
        "proj_null_if_blank": "select nct_id, sponsor_name, sponsor_class, why_stopped from stg_trials",
        "proj_rename": "select approval_key, submission_status_date as approval_date from stg_approvals",
        "proj_typed_null": "select condition_key, mesh_term, therapeutic_area from dim_condition",
        "proj_constant": "select nct_id, true as grouping_by_condition_name from fct_trials",
        "proj_compare_flag": "select nct_id, overall_status = 'TERMINATED' as is_terminated from stg_trials",
        "proj_default": """select nct_id, coalesce(phase, 'NOT REPORTED') as phase,
          coalesce(sponsor_class, 'UNKNOWN') as sponsor_class from stg_trials""",
        "filt_not_null": "select nct_id, sponsor_name from stg_trials where sponsor_name is not null",
        "filt_null": "select nct_id from fct_trials where completion_date is null",
        "filt_threshold": "select * from funnel where condition_phase2_trials >= 100",
        "filt_between": """select start_year, trial_count from metric_duration_trends
          where start_year between 2000 and 2010""",
        "filt_in_list": "select sponsor_name, sponsor_class from dim_sponsor where sponsor_class in ('INDUSTRY', 'NIH')",
        "filt_bool": "select nct_id, why_stopped from fct_trials where is_terminated",
        "filt_cutoff_split": segmented("start_year, trial_count", "metric_duration_trends"),
        # Joins and unnesting
        "join_inner_using": """select nct_id, condition_key
          from stg_trial_conditions join dim_condition using (condition_name)""",
        "join_inner_multi": """select nct_id, intervention_key
          from stg_trial_interventions join dim_intervention using (intervention_name, intervention_type)""",
        "join_left_using": """select nct_id, sponsor_name, sponsor_class
          from fct_trials left join dim_sponsor using (sponsor_key)""",
        "join_left_on": """select nct_id, sponsor_key
          from stg_trials t left join dim_sponsor d on t.sponsor_name = d.sponsor_name""",
        "join_normalized_name": """select sponsor_name, sponsor_name_norm is not null as matched_to_fda,
            fda_application_count
          from dim_sponsor left join fda_sponsors on upper(trim(sponsor_name)) = sponsor_name_norm""",
        "join_one_row_concat": "select therapeutic_area_null_rate, completion_date_null_rate from scorecard",
        "join_anti_relationship": """select sponsor_name, count(*) as child_rows from fct_approvals a
          where sponsor_name is not null
            and not exists (select 1 from dim_sponsor d where d.sponsor_name = a.sponsor_name)
          group by all""",
        "unnest_scalar_array": "select * from stg_trial_conditions",
        "unnest_object_array": "select application_number, submission_type, submission_number from stg_approvals",
        "unnest_year_range": "select * from trial_years",
        # Aggregations
        "agg_count": "select overall_status, count(*) as trial_count from stg_trials group by all",
        "agg_count_filter": """select sponsor_class, count(*) as trials_total,
          count(*) filter (overall_status = 'COMPLETED') as trials_completed from stg_trials group by all""",
        "agg_filtered_ratio": f"""select phase,
          {ratio("count(*) filter (overall_status = 'COMPLETED')", "count(*)")} as completed_rate
          from stg_trials group by all""",
        "agg_count_distinct": """select cast(year(start_date) as int) as start_year,
          count(distinct sponsor_key) as sponsors from fct_trials group by all""",
        "agg_count_distinct_filter": """select
            count(distinct condition_name) filter (phase3_to_approval_rate > 1) as over_count,
            count(distinct condition_name) as total_count
          from metric_phase_transition where condition_phase3_trials >= 5""",
        "agg_sum_avg": """select sponsor_class, cast(sum(trials_total) as bigint) as total_trials,
          round(sum(cast(round(success_rate * 1e4) as bigint)) * 1e0 / count(*)) / 1e4 as avg_success_rate
          from dim_sponsor group by all""",
        "agg_min_date": """select sponsor_key, min(start_date) as first_trial_date,
            cast(year(min(start_date)) as int) as cohort_year
          from fct_trials where start_date is not null and sponsor_key is not null group by all""",
        "agg_min_filter": """select application_number,
          min(approval_date) filter (submission_status = 'AP') as first_approval_date
          from fct_approvals group by all""",
        "agg_max": """select condition_name, max(condition_phase2_trials) as phase2_trials,
          max(phase2_to_phase3_rate) as phase2_to_phase3_rate from metric_phase_transition group by all""",
        "agg_bool_or": """select application_number, bool_or(submission_status = 'AP') as is_approved
          from fct_approvals group by all""",
        "agg_bool_and": """select application_number, bool_and(submission_status = 'AP') as all_approved
          from fct_approvals group by all""",
        "agg_bool_rate": """select phase, avg(cast(has_results as int)) as results_rate,
          avg(cast(completion_date is null as int)) as completion_date_null_rate from fct_trials group by all""",
        "agg_percentile_cont": f"select start_year, {bands} from measured group by all",
        "agg_mode_tiebreak": "select * from stg_sponsors",
        "agg_regrain": """select sponsor_name_norm, fda_application_count as application_count, has_fda_approval
          from fda_sponsors""",
        "agg_pandas_regroup": f"""select start_year, {phase_label("phase")} as phase,
            cast(sum(n) as bigint) as trial_count
          from (select cast(year(start_date) as int) as start_year, phase, count(*) as n
                from fct_trials where start_date is not null group by all)
          group by all""",
        "agg_portfolio_ratio": f"""select
          {share("sum(condition_approved_trials)", "sum(condition_phase2_trials)")} as phase2_to_approval_rate
          from funnel""",
        "distinct_rows": "select distinct condition_name from stg_trial_conditions",
        # Windows
        "win_row_number_first": """select nct_id, condition_key from bridge_trial_condition
          qualify row_number() over (partition by nct_id order by condition_key) = 1""",
        "win_row_number_over_agg": """select *, row_number() over (
            partition by sponsor_name order by n desc, sponsor_class nulls last) as place
          from (select sponsor_name, sponsor_class, count(*) as n from stg_trials
                where sponsor_name is not null group by all)""",
        "win_partition_count": """select bridge_key, count(*) over (partition by nct_id) > 1 as multi_condition_flag
          from bridge_trial_condition""",
        "win_partition_sum": """select nct_id,
            cast(sum(cast(is_phase2 as int)) over (partition by condition_name) as bigint) as condition_phase2_trials,
            cast(sum(cast(is_phase3 as int)) over (partition by condition_name) as bigint) as condition_phase3_trials
          from metric_phase_transition""",
        "win_ratio": """select nct_id, phase2_to_phase3_rate, phase3_to_approval_rate, phase2_to_approval_rate
          from metric_phase_transition""",
        "win_lag_global": """select start_year, trial_count, lag(trial_count) over (order by start_year) as prior_count
          from metric_duration_trends""",
        "win_lag_partition": """select start_year, phase, trial_count,
          lag(trial_count) over (partition by phase order by start_year) as prior_count
          from metric_duration_trends_by_phase""",
        "win_yoy": "select start_year, yoy_change_days, yoy_change_pct from metric_duration_trends",
        "win_first_value": """select cohort_year, activity_year, active_sponsor_count,
          first_value(active_sponsor_count) over (partition by cohort_year order by activity_year) as launch_count
          from metric_sponsor_cohorts""",
        "win_share_of_total": """select *, trial_count / sum(trial_count) over (partition by start_year) as value
          from phase_years where start_year between 1990 and 2024""",
        "win_rank_flag": ranked("sponsor_class in ('INDUSTRY', 'NIH', 'FED')"),
        # Sorts, limits, distinct
        "sort_multi": """select phase, start_year, trial_count from metric_duration_trends_by_phase
          order by phase, start_year desc""",
        "topk_limit": """select why_stopped, count(*) as trial_count from fct_trials where why_stopped is not null
          group by all order by trial_count desc, why_stopped limit 5""",
        "topk_members": """select * from approvals_yearly where sponsor_name in (
          select sponsor_name from approvals_yearly group by sponsor_name
          order by sum(approval_count) desc, sponsor_name limit 3)""",
        "topk_nlargest": f"""select {FUNNEL} from funnel where condition_phase2_trials >= 100
          order by condition_phase2_trials desc, condition_name nulls first limit 10""",
        "set_distinct": "select distinct overall_status, phase from fct_trials",
        # Scalar functions
        "fn_surrogate_key": f"""select nct_id, {key("nct_id", "phase", "duration_days")} as trial_key from fct_trials""",
        "fn_array_join_nullif": "select nct_id, phase from stg_trials",
        "fn_array_length": "select nct_id, num_primary_outcomes, num_sites from stg_trials",
        "fn_partial_date": "select nct_id, start_date, completion_date from stg_trials",
        "fn_compact_date": """select application_number, submission_type, submission_number, submission_status_date
          from submissions""",
        "fn_regex_match": """select application_number, submission_type, submission_number, is_compact
          from submissions""",
        "fn_date_diff": """select nct_id, cast(completion_date - start_date as int) as duration_days
          from stg_trials""",
        "fn_year": "select nct_id, cast(year(start_date) as int) as start_year from fct_trials",
        "fn_round_ratio": f"""select sponsor_name, {ratio("trials_completed", "trials_total")} as success_rate
          from dim_sponsor""",
        "fn_norm_name": "select approval_key, upper(trim(sponsor_name)) as sponsor_name_norm from fct_approvals",
        "fn_ilike": """select nct_id, coalesce(phase ilike '%phase2%', false) as is_phase2,
          coalesce(phase ilike '%phase3%', false) as is_phase3 from fct_trials""",
        "fn_case": """select nct_id, case when phase like '%PHASE2%' then 1 else 0 end as phase2_flag
          from stg_trials""",
        "fn_decode_class": f"select nct_id, {class_label('sponsor_class')} as class_label from stg_trials",
        "fn_decode_phase": f"select nct_id, {phase_label('phase')} as phase_label from stg_trials",
        "fn_fill_missing": "select nct_id, coalesce(why_stopped, 'Not Reported') as why_stopped from fct_trials",
        "fn_traffic_light": f"select sponsor_name, {light('success_rate')} as light from dim_sponsor",
        # Serving queries
        "approvals_by_sponsor_class_year": "select * from approvals_yearly",
        "top_sponsors_by_approval_count": """select coalesce(sponsor_name, 'UNKNOWN') as sponsor_name,
            count(*) as approval_count
          from applications where is_approved group by all order by approval_count desc, sponsor_name limit 20""",
        "phase_funnel_by_condition": f"select {FUNNEL} from funnel where condition_phase2_trials >= 50",
        "phase_funnel_audit_metrics": """select avg(cast(multi_condition_flag as int)) as multi_condition_flag_rate,
          avg(cast(matched_to_fda as int)) as matched_to_fda_rate, count(*) as trial_count
          from metric_phase_transition""",
        "sponsor_league_table": f"select {LEAGUE} from dim_sponsor",
        "duration_trends_overall": f"select {TREND} from metric_duration_trends",
        "duration_trends_by_phase": f"select {TREND_BY_PHASE} from metric_duration_trends_by_phase",
        "sponsor_cohort_survivorship": f"select {CURVE} from metric_sponsor_cohorts",
        "termination_rate_by_phase": f"""select coalesce(phase, 'NOT REPORTED') as phase, count(*) as trial_count,
          {terminated} as terminated_count, {ratio(terminated, "count(*)")} as termination_rate
          from fct_trials group by coalesce(phase, 'NOT REPORTED')""",
        "termination_rate_by_sponsor_class": f"""select coalesce(sponsor_class, 'UNKNOWN') as sponsor_class,
            count(*) as trial_count, {terminated} as terminated_count,
            {ratio(terminated, "count(*)")} as termination_rate
          from fct_trials left join dim_sponsor using (sponsor_key)
          group by coalesce(sponsor_class, 'UNKNOWN')""",
        "why_stopped_breakdown": """select why_stopped, count(*) as trial_count from fct_trials
          where why_stopped is not null group by all order by trial_count desc, why_stopped limit 15""",
        "why_stopped_coverage": f"""select {terminated} as terminated_trials,
          count(*) filter (is_terminated and why_stopped is not null) as terminated_with_reason from fct_trials""",
        "phase_distribution_by_year": "select * from phase_years",
        "pipeline_trust_scorecard": "select * from scorecard",
        # Dashboard derivations
        "approvals_yearly_total": """select approval_year, cast(sum(approval_count) as bigint) as approval_count
          from approvals_yearly group by all""",
        "approvals_top10_series": """select * from approvals_yearly where sponsor_name in (
          select sponsor_name from approvals_yearly group by sponsor_name
          order by sum(approval_count) desc, sponsor_name limit 10)""",
        "funnel_over_100_counts": f"""select count(*) as conditions_shown,
            count(*) filter (phase2_to_phase3_rate > 1) as over_100_phase3,
            {share("count(*) filter (phase2_to_phase3_rate > 1)", "count(*)")} as over_100_phase3_share,
            count(*) filter (phase3_to_approval_rate > 1) as over_100_approval,
            {share("count(*) filter (phase3_to_approval_rate > 1)", "count(*)")} as over_100_approval_share
          from funnel where condition_phase2_trials >= 100""",
        "funnel_top_n": f"""select {FUNNEL} from funnel where condition_phase2_trials >= 100
          order by condition_phase2_trials desc, condition_name nulls first limit 15""",
        "league_ranked": ranked("sponsor_class is not null"),
        "duration_censor_split": segmented(TREND, "metric_duration_trends"),
        "duration_phase_series_truncated": """select phase, start_year, median_duration_days
          from metric_duration_trends_by_phase
          where start_year <= 2017 and if(
            exists (select 1 from metric_duration_trends_by_phase where phase in ('PHASE1', 'PHASE2', 'PHASE3', 'PHASE4')),
            phase in ('PHASE1', 'PHASE2', 'PHASE3', 'PHASE4'),
            phase in (select distinct phase from metric_duration_trends_by_phase order by 1 limit 4))""",
        "cohort_compare": """
          select cohort_year, years_since_cohort, survivorship_rate as value from metric_sponsor_cohorts
          where if(exists (select 1 from metric_sponsor_cohorts where cohort_year in (2000, 2005, 2010, 2015, 2020)),
            cohort_year in (2000, 2005, 2010, 2015, 2020),
            cohort_year in (select distinct cohort_year from metric_sponsor_cohorts order by 1 limit 5))""",
        "why_stopped_share": f"""select {terminated} as terminated_trials,
            count(*) filter (is_terminated and why_stopped is not null) as terminated_with_reason,
            {share("count(*) filter (is_terminated and why_stopped is not null)", terminated)} as reason_share
          from fct_trials""",
        "phase_share_by_year": """select *, trial_count / sum(trial_count) over (partition by start_year) as value
          from phase_years where start_year between 1990 and 2024""",
        "trust_lights": f"""select {light("multi_condition_flag_rate")} as multi_condition_light,
            {light("1 - matched_to_fda_rate")} as fda_match_light,
            if(grouping_by_condition_name, 'amber', 'green') as grouping_light, 'amber' as therapeutic_area_light,
            {light("completion_date_null_rate")} as completion_date_light
          from scorecard""",
        # Exports
        "export_approval_landscape": """select cast(year(first_approval_date) as int) as approval_year,
            coalesce(sponsor_name, 'Unknown') as applicant_name, count(*) as approval_count
          from applications where is_approved and first_approval_date is not null group by all""",
        "export_phase_funnel": """select condition_name,
            avg(cast(multi_condition_flag as int)) as multi_condition_flag_rate,
            avg(cast(matched_to_fda as int)) as matched_to_fda_rate,
            any_value(condition_phase2_trials) as phase2_trials, any_value(condition_phase3_trials) as phase3_trials,
            any_value(condition_approved_trials) as approved_trials,
            max(phase2_to_phase3_rate) as phase2_to_phase3_rate, max(phase3_to_approval_rate) as phase3_to_approval_rate,
            max(phase2_to_approval_rate) as phase2_to_approval_rate
          from metric_phase_transition where condition_name is not null group by condition_name""",
        "export_duration_trends": f"select {TREND} from metric_duration_trends",
        "export_sponsor_cohorts": "select * exclude (cohort_activity_key) from metric_sponsor_cohorts",
        "export_termination_reasons": f"""select {phase_label("phase")} as phase,
            {class_label("sponsor_class")} as sponsor_class, coalesce(why_stopped, 'Not Reported') as why_stopped,
            enrollment_count, start_date, completion_date, duration_days
          from fct_trials left join dim_sponsor using (sponsor_key) where is_terminated""",
        "export_pipeline_trust": """select round(multi_condition_flag_rate, 4) as multi_condition_flag_rate,
            round(matched_to_fda_rate, 4) as matched_to_fda_rate, grouping_by_condition_name,
            round(therapeutic_area_null_rate, 4) as therapeutic_area_null_rate,
            round(completion_date_null_rate, 4) as completion_date_null_rate
          from scorecard""",
        # Analysis
        "insight_phase2_band": """
          with shown as (
            select condition_name, condition_phase2_trials, phase2_to_phase3_rate from funnel
            where condition_phase2_trials >= 100
          ), band as (select *, coalesce(condition_name, '') as place from shown where phase2_to_phase3_rate <= 1)
          select condition_name, condition_phase2_trials, phase2_to_phase3_rate,
            (select count(*) from shown where phase2_to_phase3_rate > 1) as over_count,
            (select count(*) from shown) as total_count,
            (select condition_name from band order by phase2_to_phase3_rate desc, place limit 1) as highest_condition,
            (select condition_name from band order by phase2_to_phase3_rate, place desc limit 1) as lowest_condition
          from band order by phase2_to_phase3_rate desc, condition_name nulls first limit 15""",
        "insight_approval_noise": """
          with shown as (
            select condition_name, condition_phase3_trials, phase3_to_approval_rate from funnel
            where condition_phase3_trials >= 5)
          select *,
            (select count(condition_name) from shown where phase3_to_approval_rate > 1) as over_count,
            (select count(condition_name) from shown) as total_count
          from shown order by phase3_to_approval_rate desc, condition_name nulls first limit 15""",
        "insight_fda_coverage": """select matched_to_fda, count(*) as trial_count,
            count(*) / (select count(*) from metric_phase_transition) as share
          from metric_phase_transition group by all""",
        "insight_cohort_2010": """
          with curve as (
            select years_since_cohort, survivorship_rate from metric_sponsor_cohorts
            where cohort_year = 2010 and years_since_cohort <= 15)
          select *, (select max(survivorship_rate) from curve where years_since_cohort = 5) as rate_after_5,
            (select max(survivorship_rate) from curve where years_since_cohort = 10) as rate_after_10
          from curve""",
        "insight_survival_5y": """select cohort_year, survivorship_rate from metric_sponsor_cohorts
          where years_since_cohort = 5 and cohort_year between 2000 and 2019""",
        "insight_volume_growth": f"""select start_year, trial_count,
            (select {ratio("max(trial_count) filter (start_year = 2020)", "max(trial_count) filter (start_year = 1990)", 1)}
             from metric_duration_trends) as growth_factor
          from metric_duration_trends where start_year between 1990 and 2023""",
        "insight_duration_censoring": f"""select *,
            (select max(median_duration_days) from metric_duration_trends where start_year = 1990) as median_1990,
            (select max(median_duration_days) from metric_duration_trends where start_year = 2020) as median_2020
          from ({segmented("start_year, median_duration_days", "metric_duration_trends", "start_year between 1985 and 2024")})""",
        # KPIs
        "kpi_phase2_to_phase3": "select distinct condition_name, phase2_to_phase3_rate from metric_phase_transition",
        "kpi_phase3_to_approval": "select distinct condition_name, phase3_to_approval_rate from metric_phase_transition",
        "kpi_sponsor_success": f"select {LEAGUE} from dim_sponsor",
        "kpi_survivorship_10y": """select cohort_year, survivorship_rate from metric_sponsor_cohorts
          where years_since_cohort = 10""",
        "kpi_median_duration_yoy": "select start_year, median_duration_days, yoy_change_pct from metric_duration_trends",
        "kpi_termination_rate": f"""select phase, {terminated} as terminated_trials, count(*) as total_trials,
          {share(terminated, "count(*)")} as termination_rate from fct_trials where phase is not null group by phase""",
        "kpi_approval_events_by_year": """select cast(year(approval_date) as int) as approval_year,
            count(*) as approval_count
          from fct_approvals where submission_status = 'AP' and approval_date is not null group by all""",
        # Quality rules
        "dq_not_null": not_null_rules(),
        "dq_unique": unique_rules(),
        "dq_accepted_values": accepted_rules(),
        "dq_relationships": relationship_rules(),
    }
    found["export_phase_distribution"] = found["agg_pandas_regroup"]
    found["export_sponsor_league_table"] = found["sink_csv"]
    found["kpi_portfolio_phase2_to_approval"] = found["agg_portfolio_ratio"]
    rates = ["multi_condition_flag_rate", "matched_to_fda_rate"]
    replaced = ", ".join(f"round({c}, 4) as {c}" for c in rates)
    found["fn_rate_round"] = f"select * replace ({replaced}) from ({found['export_phase_funnel']})"
    return found


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(f"select * from ({sql})") for name, sql in _statements().items()}
