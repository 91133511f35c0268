"""Registry tables as named SQL subqueries."""

from __future__ import annotations

import re


def key(*fields: str) -> str:
    """Digest of the fields' text."""
    return "md5(" + " || '||' || ".join(f"coalesce(cast({f} as varchar), '')" for f in fields) + ")"


def ratio(part: str, whole: str, digits: int = 4) -> str:
    """Rounded quotient; scaling before the division keeps exact ties exact."""
    return f"round(({part}) * 1e{digits} / nullif({whole}, 0)) / 1e{digits}"


def share(part: str, whole: str) -> str:
    return f"cast({part} as double) / nullif({whole}, 0)"


TABLES = {
    "study_rows": """
        select o.*, c.c_name, c.c_mktsegment, l.last_ship, l.outcomes, l.sites,
          case when length(cast(o_orderkey as varchar)) < 8
               then 'NCT' || lpad(cast(o_orderkey as varchar), 8, '0')
               else 'NCT' || cast(o_orderkey as varchar) end as nct_id,
          to_months(cast((o_custkey % 5) * 60 - 60 + if(o_orderkey % 5 = 0, 120, 0) as int)) as shift,
          substr(o_orderpriority, 1, 1) as digit
        from orders o
        left join (
          select l_orderkey, max(l_shipdate) as last_ship, count(*) as outcomes,
            count(distinct l_suppkey) as sites
          from lineitem group by all
        ) l on l.l_orderkey = o.o_orderkey
        left join customer c on c.c_custkey = o.o_custkey""",
    "raw_studies": "select nct_id, o_orderdate as fetched_at from study_rows",
    "stg_trials": """
        select nct_id,
          if(o_orderkey % 41 = 0, '', 'Study ' || o_orderkey || ' ' || o_orderpriority) as brief_title,
          case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'RECRUITING' when 'P' then 'TERMINATED' end
            as overall_status,
          case when o_orderkey % 17 = 0 then 'PHASE4' when o_orderkey % 19 = 0 then 'NA'
               when digit = '1' then 'PHASE1' when digit = '2' then 'PHASE2'
               when digit = '3' then 'PHASE2|PHASE3' when digit = '5' then 'PHASE3' end as phase,
          if(o_orderkey % 83 = 0, null, cast(floor(o_totalprice / 1000) as int)) as enrollment_count,
          case when o_orderkey % 97 = 0 or o_orderkey % 89 = 0 then null
               when o_orderkey % 3 = 0 then cast(date_trunc('month', cast(o_orderdate as date) + shift) as date)
               else cast(cast(o_orderdate as date) + shift as date) end as start_date,
          case when o_orderkey % 4 = 0 then cast(date_trunc('month', cast(last_ship as date) + shift) as date)
               else cast(cast(last_ship as date) + shift as date) end as completion_date,
          if(o_orderkey % 600 = 0 or o_orderkey % 599 = 0, null, c_name) as sponsor_name,
          case when o_orderkey % 7 = 0 then null when o_orderkey % 11 = 0 then 'OTHER_GOV'
               when o_orderkey % 13 = 0 then null
               when c_mktsegment = 'AUTOMOBILE' then 'INDUSTRY' when c_mktsegment = 'BUILDING' then 'NIH'
               when c_mktsegment = 'FURNITURE' then 'FED' when c_mktsegment = 'HOUSEHOLD' then 'NETWORK'
               when c_mktsegment = 'MACHINERY' then 'OTHER' end as sponsor_class,
          case when o_orderstatus = 'P' and o_orderkey % 5 <> 0 then
                 ['Low enrollment', 'Sponsor decision', 'Safety concerns'][o_custkey % 3 + 1]
                 || ' - ' || substr(o_orderpriority, 3)
               when o_orderstatus = 'O' and o_orderkey % 31 = 0 then 'Paused by sponsor' end as why_stopped,
          o_totalprice > 200000 as has_results,
          cast(outcomes as int) as num_primary_outcomes,
          if(o_orderkey % 10 = 0, null, cast(coalesce(sites, 0) as int)) as num_sites,
          o_orderdate as source_fetched_at
        from study_rows""",
    "stg_sponsors": """
        select sponsor_name, sponsor_class from (
          select sponsor_name, sponsor_class, count(*) as n from stg_trials where sponsor_name is not null group by all)
        qualify row_number() over (partition by sponsor_name order by n desc, sponsor_class nulls last) = 1""",
    "stg_trial_conditions": """
        select distinct s.nct_id, p_brand || ' ' || p_type as condition_name
        from study_rows s join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey
        where l_linenumber <> 5""",
    "stg_trial_interventions": """
        select distinct s.nct_id, p_name as intervention_name,
          case when p_size = 49 then null when p_size % 4 = 0 then 'DRUG'
               when p_size % 4 = 1 then 'DEVICE' when p_size % 4 = 2 then 'BIOLOGICAL' end as intervention_type
        from study_rows s join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey
        where p_size <> 50""",
    "application_rows": """
        select l_suppkey || '-' || l_partkey as application_number, l_partkey, l_suppkey,
          cast(l_shipdate as date) as ship, if(l_linenumber = 1, 'ORIG', 'SUPPL') as submission_type,
          l_linestatus, l_returnflag, l_orderkey || '-' || l_linenumber as submission_number
        from lineitem""",
    "raw_applications": """
        select application_number, cast(max(ship) as timestamp) as fetched_at from application_rows group by 1
        union all
        select 'X-' || p_partkey, timestamp '1995-01-01' from part where p_partkey % 50 = 0""",
    "submissions": f"""
        select {key("a.application_number", "submission_type", "submission_number")} as approval_key,
          a.application_number,
          if(l_partkey % 37 = 0 or l_partkey % 41 = 0, null, ' ' || replace(s_name, 'Supplier', 'CUSTOMER') || ' ')
            as sponsor_name,
          submission_type, submission_number,
          case when day(ship) in (13, 14) then null when l_linestatus = 'F' then 'AP'
               when l_linestatus = 'O' then 'TA' end as submission_status,
          if(day(ship) in (28, 29), null, ship) as submission_status_date,
          case when l_returnflag = 'A' then 'STANDARD'
               when l_returnflag = 'R' and day(ship) <> 7 then 'PRIORITY' end as review_priority,
          case when day(ship) = 29 then null else day(ship) <> 28 end as is_compact,
          r.fetched_at as source_fetched_at
        from application_rows a
        join raw_applications r using (application_number)
        left join supplier on s_suppkey = l_suppkey""",
    "stg_approvals": "select * exclude (is_compact) from submissions",
    "dim_sponsor": f"""
        select {key("s.sponsor_name")} as sponsor_key, s.sponsor_name, s.sponsor_class, trials_total,
          trials_completed, {ratio("trials_completed", "trials_total")} as success_rate
        from stg_sponsors s join (
          select sponsor_name, count(*) as trials_total,
            count(*) filter (overall_status = 'COMPLETED') as trials_completed
          from stg_trials group by all) t using (sponsor_name)""",
    "dim_condition": f"""
        select {key("condition_name")} as condition_key, condition_name,
          cast(null as varchar) as mesh_term, cast(null as varchar) as therapeutic_area
        from (select distinct condition_name from stg_trial_conditions)""",
    "dim_intervention": f"""
        select {key("intervention_name", "intervention_type")} as intervention_key, intervention_name,
          intervention_type
        from (select distinct intervention_name, intervention_type from stg_trial_interventions)""",
    "bridge_trial_condition": f"""
        select {key("nct_id", "condition_key")} as bridge_key, nct_id, condition_key
        from stg_trial_conditions join dim_condition using (condition_name)""",
    "bridge_trial_intervention": f"""
        select {key("nct_id", "intervention_key")} as bridge_key, nct_id, intervention_key
        from stg_trial_interventions join dim_intervention using (intervention_name, intervention_type)""",
    "fct_trials": """
        select nct_id, sponsor_key, phase, overall_status, enrollment_count, start_date, completion_date,
          cast(date_diff('day', start_date, completion_date) as int) as duration_days,
          overall_status = 'TERMINATED' as is_terminated, why_stopped, has_results, num_primary_outcomes, num_sites
        from stg_trials t left join dim_sponsor d on d.sponsor_name = t.sponsor_name""",
    "fct_approvals": """
        select approval_key, application_number, sponsor_name, submission_type, submission_status,
          submission_status_date as approval_date, review_priority
        from stg_approvals""",
    "applications": """
        select application_number, sponsor_name, bool_or(submission_status = 'AP') as is_approved,
          min(approval_date) filter (submission_status = 'AP') as first_approval_date
        from fct_approvals group by all""",
    "fda_sponsors": """
        select upper(trim(sponsor_name)) as sponsor_name_norm,
          count(distinct application_number) as fda_application_count, bool_or(is_approved) as has_fda_approval
        from applications where sponsor_name is not null group by all""",
    "metric_phase_transition": f"""
        with chosen as (
          select nct_id, min(condition_key) as condition_key, count(*) > 1 as multi
          from bridge_trial_condition group by all
        ), flagged as (
          select t.nct_id, condition_key, condition_name, therapeutic_area, true as grouping_by_condition_name,
            coalesce(multi, false) as multi_condition_flag, phase,
            coalesce(phase ilike '%phase2%', false) as is_phase2, coalesce(phase ilike '%phase3%', false) as is_phase3,
            sponsor_name, f.sponsor_name_norm is not null as matched_to_fda,
            coalesce(f.has_fda_approval, false) as has_fda_approval
          from fct_trials t
          left join dim_sponsor using (sponsor_key)
          left join fda_sponsors f on f.sponsor_name_norm = upper(trim(sponsor_name))
          left join chosen using (nct_id)
          left join dim_condition using (condition_key)
        ), volumes as (
          select *, count(*) filter (is_phase2) over same as condition_phase2_trials,
            count(*) filter (is_phase3) over same as condition_phase3_trials,
            count(*) filter (matched_to_fda and has_fda_approval) over same as condition_approved_trials
          from flagged window same as (partition by condition_name)
        )
        select *,
          {ratio("condition_phase3_trials", "condition_phase2_trials")} as phase2_to_phase3_rate,
          {ratio("condition_approved_trials", "condition_phase3_trials")} as phase3_to_approval_rate,
          {ratio("condition_approved_trials", "condition_phase2_trials")} as phase2_to_approval_rate
        from volumes""",
    "funnel": """
        select distinct condition_name, condition_phase2_trials, condition_phase3_trials, condition_approved_trials,
          phase2_to_phase3_rate, phase3_to_approval_rate, phase2_to_approval_rate
        from metric_phase_transition""",
    "sponsor_first": """
        select d.*, cast(year(min(start_date)) as int) as cohort_year
        from dim_sponsor d join fct_trials using (sponsor_key) where start_date is not null group by all""",
    "trial_years": """
        select sponsor_key, nct_id, cast(unnest(generate_series(year(start_date),
          coalesce(year(completion_date), year(start_date)))) as int) as activity_year
        from fct_trials where start_date is not null and sponsor_key is not null""",
    "metric_sponsor_cohorts": f"""
        with active as (
          select cohort_year, activity_year, count(distinct sponsor_key) as active_sponsor_count
          from trial_years join sponsor_first using (sponsor_key) where activity_year >= cohort_year group by all
        ), cohorts as (
          select cohort_year, count(*) as cohort_sponsor_count, cast(sum(trials_total) as bigint) as cohort_total_trials,
            cast(sum(trials_completed) as bigint) as cohort_total_completed,
            round(sum(cast(round(success_rate * 1e4) as bigint)) * 1e0 / count(*)) / 1e4 as cohort_avg_success_rate
          from sponsor_first group by all
        ), launched as (
          select *, first_value(active_sponsor_count) over (partition by cohort_year order by activity_year)
            as cohort_launch_sponsor_count
          from active
        )
        select {key("cohort_year", "activity_year")} as cohort_activity_key, cohort_year, activity_year,
          activity_year - cohort_year as years_since_cohort, active_sponsor_count, cohort_launch_sponsor_count,
          {ratio("active_sponsor_count", "cohort_launch_sponsor_count")} as survivorship_rate,
          cohort_sponsor_count, cohort_total_trials, cohort_total_completed, cohort_avg_success_rate
        from launched left join cohorts using (cohort_year)""",
    "measured": """
        select cast(year(start_date) as int) as start_year, phase, duration_days
        from fct_trials where duration_days is not null and start_date is not null""",
    "metric_duration_trends": f"""
        with bands as (
          select start_year, count(*) as trial_count, quantile_cont(duration_days, 0.25) as p25,
            quantile_cont(duration_days, 0.5) as p50, quantile_cont(duration_days, 0.75) as p75
          from measured group by all
        ), lagged as (select *, lag(p50) over (order by start_year) as before from bands)
        select start_year, trial_count, round(p25, 1) as p25_duration_days, round(p50, 1) as median_duration_days,
          round(p75, 1) as p75_duration_days, round(before, 1) as prior_year_median_duration_days,
          round(p50 - before, 1) as yoy_change_days, {ratio("(p50 - before) * 100", "before", 2)} as yoy_change_pct
        from lagged""",
    "metric_duration_trends_by_phase": f"""
        with bands as (
          select start_year, phase, count(*) as trial_count, quantile_cont(duration_days, 0.25) as p25,
            quantile_cont(duration_days, 0.5) as p50, quantile_cont(duration_days, 0.75) as p75
          from measured where phase is not null group by all
        ), lagged as (select *, lag(p50) over (partition by phase order by start_year) as before from bands)
        select {key("start_year", "phase")} as duration_by_phase_key, start_year, phase, trial_count,
          round(p25, 1) as p25_duration_days, round(p50, 1) as median_duration_days,
          round(p75, 1) as p75_duration_days, round(before, 1) as prior_year_median_duration_days,
          round(p50 - before, 1) as yoy_change_days
        from lagged""",
    "records": """
        select 'U' || user_id as record_id, event_id, event_type, ts as fetched_at,
          cast(event_id // 1000 as bigint) as page, cast(event_id % 1000 as bigint) as pos
        from events""",
    "approvals_yearly": """
        select cast(year(first_approval_date) as int) as approval_year, coalesce(sponsor_name, 'UNKNOWN') as sponsor_name,
          count(*) as approval_count
        from applications where is_approved and first_approval_date is not null group by all""",
    "phase_years": """
        select cast(year(start_date) as int) as start_year, coalesce(phase, 'NOT REPORTED') as phase,
          count(*) as trial_count
        from fct_trials where start_date is not null group by all""",
    "scorecard": """
        select avg(cast(multi_condition_flag as int)) as multi_condition_flag_rate,
          avg(cast(matched_to_fda as int)) as matched_to_fda_rate,
          bool_and(grouping_by_condition_name) as grouping_by_condition_name,
          (select avg(cast(therapeutic_area is null as int)) from dim_condition) as therapeutic_area_null_rate,
          (select avg(cast(completion_date is null as int)) from fct_trials) as completion_date_null_rate
        from metric_phase_transition""",
}


def _mentioned(sql: str) -> list[str]:
    return [name for name in TABLES if re.search(rf"\b{name}\b", sql)]


def with_tables(sql: str) -> str:
    """``sql`` preceded by the subqueries it needs, each after those it reads itself."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for source in _mentioned(TABLES[name]):
            if source != name:
                add(source)
        if name not in ordered:
            ordered.append(name)

    for name in _mentioned(sql):
        add(name)
    if not ordered:
        return sql
    return "with " + ",\n".join(f"{name} as materialized ({TABLES[name]})" for name in ordered) + "\n" + sql
