"""Incident cohort, feasibility and pre-index profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casewright.operators import incident, profile
from casewright.operators.describe import suppress_small_counts
from casewright.plans.cohort_queries import TIER_SQL, tiered
from casewright.plans.registry import query
from casewright.session import cut_lineage
from casewright.sources.lens import INCIDENT, Lens

HISTORY = list(INCIDENT.history)
LABS = [r.label for r in INCIDENT.labs]


def cohort(lens: Lens) -> DataFrame:
    return incident.build_incident_cohort(
        lens.demographics, lens.observation_period, lens.condition, lens.measurement, INCIDENT, lens.ancestry
    )


_LAB_TESTS = {
    "ck": "concept_id IN (0,1,2,3)",
    "creatinine": "concept_id IN (4,5)",
    "ast": "concept_id = 10",
    "alt": "concept_id = 11",
    "sodium": "concept_id IN (6,7)",
    "potassium": "(contains(concept_name, 'lab 8') OR contains(concept_name, 'lab 9'))",
    "calcium": "concept_id IN (12,13)",
    "tsh": "concept_id = 14",
}
_HISTORY_TESTS = {
    "prior_kidney_disease_or_aki": "concept_id IN (13,21,22,23)",
    "remote_sepsis_history": "concept_id = 12",
    "prior_heat_illness_or_dehydration": "concept_id IN (41,42)",
    "prior_exertion_or_exercise_code": "concept_id IN (43,44)",
    "prior_myopathy_muscle_disease": "concept_id IN (45,46,47)",
    "prior_sickle_trait_or_disease": "concept_id = 48",
    "prior_diabetes": "concept_id IN (31,32,33,34)",
    "prior_thyroid_disease": "concept_id IN (51,52)",
    "prior_liver_disease": "concept_id IN (53,54,55)",
    "prior_alcohol_substance_condition": "contains(lower(concept_name), 'urgent')",
    "prior_injury_trauma_history": "concept_id IN (61,62,63,64)",
}
INCIDENT_SQL = (
    """
, imode AS (SELECT MAX(CASE WHEN source_vocabulary LIKE 'ICD%' THEN 1 ELSE 0 END) AS icd FROM condition),
den AS (SELECT DISTINCT person_id, event_date FROM condition, imode WHERE icd = 0 OR source_vocabulary LIKE 'ICD%'),
den2 AS (SELECT person_id, event_date, ROW_NUMBER() OVER (PARTITION BY person_id ORDER BY event_date) AS k FROM den),
roll AS (SELECT person_id, COUNT(*) AS condition_dates, MAX(event_date) AS last_condition_date,
  MAX(CASE WHEN k = 2 THEN event_date END) AS second_condition_date FROM den2 GROUP BY 1),
lastm AS (SELECT person_id, MAX(event_date) AS last_measurement_date FROM measurement GROUP BY 1),
act AS (SELECT person_id, event_date FROM den UNION SELECT person_id, event_date FROM measurement),
b0 AS (SELECT p.person_id, p.sex, p.is_female, p.year_of_birth, p.ancestry_pred, o.obs_start_date, o.obs_end_date, o.obs_start_date + 365 AS washout_end_date,
  COALESCE(r.condition_dates, 0) AS condition_dates, r.second_condition_date, r.last_condition_date, m.last_measurement_date
  FROM person p LEFT JOIN obs o USING (person_id) LEFT JOIN roll r USING (person_id) LEFT JOIN lastm m USING (person_id)),
bd AS (SELECT b.person_id, MIN(a.event_date) AS baseline_date FROM b0 b JOIN act a ON a.person_id = b.person_id
  AND a.event_date >= b.washout_end_date AND a.event_date >= b.second_condition_date GROUP BY 1),
b1 AS (SELECT b0.*, bd.baseline_date, bd.baseline_date + 730 AS horizon_end_date,
  CASE WHEN bd.baseline_date IS NOT NULL AND condition_dates >= 2 AND washout_end_date <= bd.baseline_date THEN 1 ELSE 0 END AS eligible_denominator
  FROM b0 LEFT JOIN bd USING (person_id)),
tgt AS (SELECT b.person_id, MIN(c.event_date) AS first_target_ever_date,
  MIN(CASE WHEN c.event_date < b.baseline_date THEN c.event_date END) AS prior_target_date,
  MIN(CASE WHEN c.event_date > b.baseline_date AND c.event_date <= b.horizon_end_date THEN c.event_date END) AS first_target_date
  FROM b1 b JOIN condition c ON b.person_id = c.person_id AND c.concept_id BETWEEN 3 AND 8 GROUP BY 1),
b2 AS (SELECT b1.*, tgt.first_target_ever_date, tgt.prior_target_date, tgt.first_target_date FROM b1 LEFT JOIN tgt USING (person_id)),
ckr AS (SELECT b.person_id,
  MAX(CASE WHEN value >= 45 AND event_date < baseline_date THEN 1 ELSE 0 END) AS prior_high_ck,
  MAX(CASE WHEN value >= 45 AND event_date > baseline_date AND event_date <= horizon_end_date THEN 1 ELSE 0 END) AS high_ck_during_horizon,
  MAX(CASE WHEN event_date > baseline_date AND event_date <= horizon_end_date THEN 1 ELSE 0 END) AS ck_tested_during_horizon,
  MAX(CASE WHEN event_date < baseline_date THEN 1 ELSE 0 END) AS ck_tested_prebaseline
  FROM b2 b JOIN measurement m ON b.person_id = m.person_id AND m.concept_id < 4 GROUP BY 1),
ckn AS (SELECT person_id, event_date AS ck_confirming_date, value AS ck_confirming_value FROM (
  SELECT b.person_id, m.event_date, m.value, ROW_NUMBER() OVER (PARTITION BY b.person_id
    ORDER BY abs(date_diff('day', b.first_target_date, m.event_date)), m.event_date, m.value DESC) AS rn
  FROM b2 b JOIN measurement m ON b.person_id = m.person_id AND m.concept_id < 4 AND m.value >= 45
    AND date_diff('day', b.first_target_date, m.event_date) BETWEEN -90 AND 365) WHERE rn = 1),
cof2 AS (SELECT b.person_id,
  MAX(CASE WHEN concept_id IN (11, 14) AND date_diff('day', first_target_date, event_date) BETWEEN -30 AND 30 THEN 1 ELSE 0 END) AS excluded_periindex_trauma,
  MAX(CASE WHEN concept_id = 12 AND date_diff('day', first_target_date, event_date) BETWEEN -90 AND 0 THEN 1 ELSE 0 END) AS excluded_pre_or_same_day_sepsis,
  MAX(CASE WHEN (concept_id = 15 OR contains(concept_name, '-16')) AND date_diff('day', first_target_date, event_date) BETWEEN -365 AND 365 THEN 1 ELSE 0 END) AS supportive_code,
  """
    + ",\n  ".join(f"MAX(CASE WHEN {t} AND event_date < baseline_date THEN 1 ELSE 0 END) AS {n}" for n, t in _HISTORY_TESTS.items())
    + """ FROM b2 b JOIN condition c ON b.person_id = c.person_id GROUP BY 1),
labr AS (SELECT b.person_id, """
    + ",\n  ".join(
        f"arg_max(value, CASE WHEN {t} THEN struct_pack(d := event_date, v := value) END) FILTER (WHERE {t}) AS prebaseline_{n}_last, "
        f"MAX(value) FILTER (WHERE {t}) AS prebaseline_{n}_max, NULLIF(COUNT(value) FILTER (WHERE {t}), 0) AS prebaseline_{n}_n"
        for n, t in _LAB_TESTS.items()
    )
    + """ FROM b2 b JOIN measurement m ON b.person_id = m.person_id AND m.event_date < b.baseline_date GROUP BY 1),
b3 AS (SELECT b2.*, COALESCE(prior_high_ck, 0) AS prior_high_ck, COALESCE(high_ck_during_horizon, 0) AS high_ck_during_horizon,
  COALESCE(ck_tested_during_horizon, 0) AS ck_tested_during_horizon, COALESCE(ck_tested_prebaseline, 0) AS ck_tested_prebaseline,
  ck_confirming_date, ck_confirming_value, CASE WHEN ck_confirming_date IS NOT NULL THEN 1 ELSE 0 END AS ck_confirmed_index,
  COALESCE(excluded_periindex_trauma, 0) AS excluded_periindex_trauma,
  COALESCE(excluded_pre_or_same_day_sepsis, 0) AS excluded_pre_or_same_day_sepsis, COALESCE(supportive_code, 0) AS supportive_code,
  CASE WHEN first_target_date IS NOT NULL THEN 1 ELSE 0 END AS target_during_horizon,
  GREATEST(last_condition_date, last_measurement_date) AS last_activity,
  """
    + ", ".join(f"COALESCE({n}, 0) AS {n}" for n in _HISTORY_TESTS)
    + ", "
    + ", ".join(f"prebaseline_{n}_{s}" for n in _LAB_TESTS for s in ("last", "max", "n"))
    + """
  FROM b2 LEFT JOIN ckr USING (person_id) LEFT JOIN ckn USING (person_id) LEFT JOIN cof2 USING (person_id) LEFT JOIN labr USING (person_id)),
b4 AS (SELECT *, CASE WHEN eligible_denominator = 1 AND prior_target_date IS NULL AND prior_high_ck = 0 THEN 1 ELSE 0 END AS incident_denominator,
  CASE WHEN obs_end_date >= horizon_end_date AND (last_activity IS NULL OR last_activity >= baseline_date) THEN 1 ELSE 0 END AS observed_followup_through_horizon FROM b3),
b5 AS (SELECT *, CASE WHEN incident_denominator = 1 AND first_target_date IS NOT NULL AND excluded_periindex_trauma = 0
    AND excluded_pre_or_same_day_sepsis = 0 THEN 1 ELSE 0 END AS diagnosis_only_case,
  CASE WHEN incident_denominator = 1 AND target_during_horizon = 0 AND high_ck_during_horizon = 1 THEN 1 ELSE 0 END AS ck_only_no_target,
  CASE WHEN incident_denominator = 1 AND observed_followup_through_horizon = 1 AND target_during_horizon = 0 AND high_ck_during_horizon = 0 THEN 1 ELSE 0 END AS eligible_control FROM b4),
inc AS (SELECT *, CASE WHEN diagnosis_only_case = 1 AND ck_confirmed_index = 1 THEN 1 ELSE 0 END AS primary_case,
  CASE WHEN diagnosis_only_case = 1 AND ck_confirmed_index = 1 AND supportive_code = 1 THEN 1 ELSE 0 END AS supportive_coded_case,
  CASE WHEN eligible_control = 1 AND ck_tested_during_horizon = 1 THEN 1 ELSE 0 END AS ck_tested_control,
  CASE WHEN diagnosis_only_case = 1 AND ck_confirmed_index = 1 THEN 'incident_primary' WHEN diagnosis_only_case = 1 THEN 'diagnosis_only'
    WHEN ck_only_no_target = 1 THEN 'ck_only_no_target' WHEN eligible_control = 1 THEN 'control' ELSE 'excluded_or_unclassified' END AS case_tier,
  CAST(YEAR(baseline_date) AS DOUBLE) - year_of_birth AS age_at_baseline FROM b5),
inc_elig AS (SELECT *, primary_case AS analysis_case FROM inc WHERE primary_case = 1 OR eligible_control = 1)
"""
)
_DATE_COLUMNS = [
    "washout_end_date", "second_condition_date", "baseline_date", "horizon_end_date", "first_target_ever_date",
    "prior_target_date", "first_target_date", "ck_confirming_date",
]
_FLAG_COLUMNS = [
    "eligible_denominator", "incident_denominator", "prior_high_ck", "high_ck_during_horizon",
    "ck_tested_during_horizon", "ck_tested_prebaseline", "ck_confirmed_index", "excluded_periindex_trauma",
    "excluded_pre_or_same_day_sepsis", "supportive_code", "target_during_horizon",
    "observed_followup_through_horizon", "diagnosis_only_case", "ck_only_no_target", "eligible_control",
    "primary_case", "supportive_coded_case", "ck_tested_control", "condition_dates", *HISTORY,
]
_LAB_COLUMNS = [f"prebaseline_{n}_{s}" for n in LABS for s in ("last", "max", "n")]


@query(
    "incident_cohort_rows",
    INCIDENT_SQL
    + "SELECT person_id, case_tier, age_at_baseline, ck_confirming_value, "
    + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _DATE_COLUMNS)
    + ", "
    + ", ".join(_FLAG_COLUMNS)
    + " FROM inc",
)
def incident_rows(lens: Lens) -> DataFrame:
    return cohort(lens).select(
        "person_id", "case_tier", "age_at_baseline", "ck_confirming_value", *_DATE_COLUMNS, *_FLAG_COLUMNS
    )


@query("incident_lab_history", INCIDENT_SQL + "SELECT person_id, " + ", ".join(_LAB_COLUMNS) + " FROM inc")
def lab_history(lens: Lens) -> DataFrame:
    return cohort(lens).select("person_id", *_LAB_COLUMNS)


_CONSORT = {
    "source_rows": "COUNT(*)",
    "observation_rows": "COUNT(obs_start_date)",
    "eligible_denominator": "SUM(eligible_denominator)",
    "excluded_prior_target": "COUNT(prior_target_date)",
    "excluded_prior_high_ck": "SUM(prior_high_ck)",
    "incident_denominator": "SUM(incident_denominator)",
    "target_in_horizon": "SUM(target_during_horizon)",
    "target_with_confirming_lab": "SUM(ck_confirmed_index)",
    "excluded_trauma": "SUM(excluded_periindex_trauma)",
    "excluded_sepsis": "SUM(excluded_pre_or_same_day_sepsis)",
    "primary_cases": "SUM(primary_case)",
    "diagnosis_only_cases": "SUM(diagnosis_only_case)",
    "supportive_coded_cases": "SUM(supportive_coded_case)",
    "ck_only_no_target": "SUM(ck_only_no_target)",
    "eligible_controls": "SUM(eligible_control)",
    "ck_tested_controls": "SUM(ck_tested_control)",
    "model_eligible_rows": "SUM(CASE WHEN primary_case = 1 OR eligible_control = 1 THEN 1 ELSE 0 END)",
}


@query(
    "incident_consort_funnel",
    INCIDENT_SQL + " UNION ALL ".join(f"SELECT '{k}' AS step, CAST({v} AS BIGINT) AS n FROM inc" for k, v in _CONSORT.items()),
)
def consort(lens: Lens) -> DataFrame:
    return incident.incident_consort(cohort(lens))


@query(
    "incident_consort_suppressed",
    INCIDENT_SQL
    + "SELECT step, CASE WHEN n BETWEEN 1 AND 20 THEN '<=20' ELSE CAST(n AS VARCHAR) END AS n FROM ("
    + " UNION ALL ".join(f"SELECT '{k}' AS step, CAST({v} AS BIGINT) AS n FROM inc" for k, v in _CONSORT.items())
    + ")",
)
def consort_suppressed(lens: Lens) -> DataFrame:
    return suppress_small_counts(incident.incident_consort(cohort(lens)))


_NT = "(incident_denominator = 1 AND first_target_date IS NOT NULL AND excluded_periindex_trauma = 0)"
_IC = "(incident_denominator = 1 AND first_target_date IS NOT NULL)"
_HIST = "date_diff('day', obs_start_date, first_target_ever_date)"
_FEAS = [
    ("case_funnel", "All participants", "TRUE"),
    ("case_funnel", "Any target ever", "first_target_ever_date IS NOT NULL"),
    ("case_funnel", "First target within horizon", "first_target_date IS NOT NULL"),
    ("case_funnel", "With baseline history", "first_target_date IS NOT NULL AND eligible_denominator = 1"),
    ("case_funnel", "No prior target or high lab", _IC),
    ("case_funnel", "Non-trauma incident cases", _NT),
    ("case_funnel", "Lab-confirmed non-trauma cases", f"{_NT} AND ck_confirmed_index = 1"),
    ("case_funnel", "Supportive-coded non-trauma cases", f"{_NT} AND supportive_code = 1"),
    ("case_funnel", "Sepsis-flagged non-trauma cases", f"{_NT} AND excluded_pre_or_same_day_sepsis = 1"),
    ("control_funnel", "Incident denominator", "incident_denominator = 1"),
    ("control_funnel", "No target during horizon", "incident_denominator = 1 AND target_during_horizon = 0"),
    ("control_funnel", "No target or high lab during horizon", "incident_denominator = 1 AND target_during_horizon = 0 AND high_ck_during_horizon = 0"),
    ("control_funnel", "Observed through horizon", "incident_denominator = 1 AND observed_followup_through_horizon = 1"),
    ("control_funnel", "Eligible controls", "eligible_control = 1"),
    ("control_funnel", "Lab-tested eligible controls", "ck_tested_control = 1"),
    ("feasibility_counts", "Non-trauma incident cases", _NT),
    ("feasibility_counts", "Lab-confirmed non-trauma cases", f"{_NT} AND ck_confirmed_index = 1"),
    ("feasibility_counts", "Eligible controls", "eligible_control = 1"),
    ("feasibility_counts", "Case-control rows", f"{_NT} OR eligible_control = 1"),
    ("baseline_history_bins", "<365d before first event", f"{_HIST} <= 364"),
    ("baseline_history_bins", "365-729d before first event", f"{_HIST} BETWEEN 365 AND 729"),
    ("baseline_history_bins", "730-1094d before first event", f"{_HIST} BETWEEN 730 AND 1094"),
    ("baseline_history_bins", ">=1095d before first event", f"{_HIST} >= 1095"),
]


@query(
    "feasibility_summary",
    INCIDENT_SQL
    + " UNION ALL ".join(
        f"SELECT '{s}' AS section, '{m}' AS metric, COUNT(*) FILTER (WHERE {t}) AS n FROM inc" for s, m, t in _FEAS
    ),
)
def feasibility(lens: Lens) -> DataFrame:
    return incident.feasibility_summary(cohort(lens))


@query(
    "feasibility_ids",
    INCIDENT_SQL
    + f"""SELECT person_id, CAST({_NT} AS INT) AS nontrauma_case, CAST(({_NT} AND ck_confirmed_index = 1) AS INT) AS ck_confirmed_nontrauma_case,
  CAST(({_NT} AND supportive_code = 1) AS INT) AS supportive_nontrauma_case,
  CAST(({_NT} AND excluded_pre_or_same_day_sepsis = 1) AS INT) AS sepsis_flagged_nontrauma_case, eligible_control, ck_tested_control
FROM inc WHERE {_NT} OR eligible_control = 1""",
)
def feasibility_ids(lens: Lens) -> DataFrame:
    return incident.feasibility_ids(cohort(lens))


@query(
    "feasibility_genotyped_overlap",
    INCIDENT_SQL
    + f""", f AS (SELECT person_id, CAST({_NT} AS INT) AS nontrauma_case, CAST(({_NT} AND ck_confirmed_index = 1) AS INT) AS ck_confirmed_nontrauma_case,
  CAST(({_NT} AND supportive_code = 1) AS INT) AS supportive_nontrauma_case,
  CAST(({_NT} AND excluded_pre_or_same_day_sepsis = 1) AS INT) AS sepsis_flagged_nontrauma_case, eligible_control, ck_tested_control
FROM inc WHERE {_NT} OR eligible_control = 1),
g AS (SELECT person_id FROM person WHERE has_wgs = 1), fg AS (SELECT f.* FROM f SEMI JOIN g USING (person_id))
SELECT 'genotype_sample_ids' AS metric, COUNT(*) AS n FROM g UNION ALL SELECT 'ids_queried', COUNT(*) FROM f
UNION ALL SELECT 'nontrauma_cases', COALESCE(SUM(nontrauma_case), 0) FROM f
"""
    + " ".join(
        f"UNION ALL SELECT '{c}_genotyped', COALESCE(SUM({c}), 0) FROM fg"
        for c in ("nontrauma_case", "ck_confirmed_nontrauma_case", "supportive_nontrauma_case",
                  "sepsis_flagged_nontrauma_case", "eligible_control", "ck_tested_control")
    ),
)
def overlap(lens: Lens) -> DataFrame:
    ids = lens.person.filter("has_wgs = 1").select(F.col("person_id").alias("IID"))
    return incident.genotyped_overlap(incident.feasibility_ids(cohort(lens)), ids)


# Profile ---------------------------------------------------------------------------------------

WINDOWS = [("365d", 365), ("1095d", 1095), ("any_prior", None)]
LENS_BIOMARKERS = {f"marker_{i}": (f"Lab {i}", f"alt name {i}") for i in range(0, 12)} | {"absent": ("no such lab",)}
PROFILE_SQL = (
    TIER_SQL
    + """, cs AS (SELECT person_id, index_date, obs_start_date, date_diff('day', obs_start_date, index_date) AS obs_days FROM cohort
  WHERE broad_case = 1 AND index_date IS NOT NULL),
wins(win, days) AS (VALUES ('365d', 365), ('1095d', 1095), ('any_prior', 1000000)),
ncs AS (SELECT COUNT(DISTINCT person_id) AS n_cases FROM cs)
"""
)


def _cases(lens: Lens) -> DataFrame:
    return profile.case_frame(tiered(lens))


@query(
    "preindex_event_summary",
    PROFILE_SQL
    + """, ev AS (SELECT c.person_id, date_diff('day', e.event_date, c.index_date) AS d FROM cs c JOIN condition e
  ON e.person_id = c.person_id AND e.event_date < c.index_date),
pp AS (SELECT win, person_id, COUNT(*) AS k FROM ev JOIN wins ON d BETWEEN 1 AND days GROUP BY 1, 2)
SELECT 'condition' AS domain, w.win AS "window", n_cases, COUNT(k) AS n_cases_with_any, ROUND(COUNT(k) * 100.0::DOUBLE / n_cases, 2) AS pct_cases_with_any,
  COALESCE(SUM(k), 0) AS total_events, quantile_cont(k, 0.5) AS median_events_per_case_with_any
FROM wins w LEFT JOIN pp ON pp.win = w.win, ncs GROUP BY w.win, n_cases""",
)
def event_summary(lens: Lens) -> DataFrame:
    cases = _cases(lens)
    return profile.event_summary(profile.preindex_events(lens.condition, cases), cases, "condition", WINDOWS)


@query(
    "preindex_top_concepts",
    PROFILE_SQL
    + """, ev AS (SELECT c.person_id, CAST(e.concept_id AS VARCHAR) AS concept_id, e.concept_name,
  date_diff('day', e.event_date, c.index_date) AS d FROM cs c JOIN measurement e ON e.person_id = c.person_id AND e.event_date < c.index_date),
g AS (SELECT win, concept_id, concept_name, COUNT(DISTINCT person_id) AS n_cases, COUNT(*) AS total_events,
  quantile_cont(d, 0.5) AS med FROM ev JOIN wins ON d BETWEEN 1 AND days GROUP BY 1, 2, 3),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY win ORDER BY n_cases DESC, total_events DESC, concept_name, concept_id) AS rk FROM g)
SELECT 'measurement' AS domain, win AS "window", concept_id, concept_name, n_cases, total_events, ROUND(med, 6) AS median_days_before_index, rk AS rank
FROM r WHERE rk <= 10""",
)
def top_concepts(lens: Lens) -> DataFrame:
    cases = _cases(lens)
    return profile.top_concepts(profile.preindex_events(lens.measurement, cases), "measurement", WINDOWS, 10)


@query(
    "preindex_biomarkers",
    PROFILE_SQL
    + """, ev AS (SELECT c.person_id, e.concept_name, e.value, date_diff('day', e.event_date, c.index_date) AS d
  FROM cs c JOIN measurement e ON e.person_id = c.person_id AND e.event_date < c.index_date),
markers(biomarker, term) AS (VALUES """
    + ", ".join(f"('{k}', '{v[0].lower()}')" for k, v in LENS_BIOMARKERS.items())
    + """),
g AS (SELECT biomarker, win, COUNT(DISTINCT person_id) AS people, COUNT(*) AS rows_, quantile_cont(value, 0.5) AS med
  FROM ev JOIN markers ON contains(concept_name, term) JOIN wins ON d BETWEEN 1 AND days GROUP BY 1, 2)
SELECT m.biomarker, w.win AS "window", n_cases, COALESCE(people, 0) AS n_cases_with_measurement,
  ROUND(COALESCE(people, 0) * 100.0::DOUBLE / n_cases, 2) AS pct_cases_with_measurement, COALESCE(rows_, 0) AS total_measurements, med AS median_value
FROM markers m CROSS JOIN wins w CROSS JOIN ncs LEFT JOIN g ON g.biomarker = m.biomarker AND g.win = w.win""",
)
def biomarkers(lens: Lens) -> DataFrame:
    cases = cut_lineage(_cases(lens))  # read by the events and by the total
    events = profile.preindex_events(lens.measurement, cases, "value")
    return profile.biomarker_availability(events, cases, WINDOWS, LENS_BIOMARKERS)


@query(
    "preindex_observation_history",
    PROFILE_SQL
    + """SELECT 'observation_history' AS domain, n_cases, w AS "window", k AS n_cases_with_any, ROUND(k * 100.0::DOUBLE / n_cases, 2) AS pct_cases_with_any
FROM ncs, (SELECT 'preindex' AS w, COUNT(*) FILTER (WHERE obs_days > 0) AS k FROM cs
  UNION ALL SELECT '>=365d', COUNT(*) FILTER (WHERE obs_days >= 365) FROM cs
  UNION ALL SELECT '>=1095d', COUNT(*) FILTER (WHERE obs_days >= 1095) FROM cs)""",
)
def observation_history(lens: Lens) -> DataFrame:
    return profile.observation_history(_cases(lens), WINDOWS)


# Streams of activity: the same profile over the event table, anchored at each user's first error.

@query(
    "activity_anchored_profile",
    """WITH fe AS (SELECT user_id, MIN(CAST(ts AS DATE)) AS index_date FROM events WHERE event_type = 'error' GROUP BY 1),
ev AS (SELECT e.user_id, event_type, date_diff('day', CAST(ts AS DATE), index_date) AS d FROM events e JOIN fe USING (user_id)),
wins(win, days) AS (VALUES ('3d', 3), ('7d', 7), ('any_prior', 1000000)),
g AS (SELECT win, event_type, COUNT(DISTINCT user_id) AS n_cases, COUNT(*) AS total_events, quantile_cont(d, 0.5) AS med
  FROM ev JOIN wins ON d BETWEEN 1 AND days GROUP BY 1, 2)
SELECT 'activity' AS domain, win AS "window", event_type AS concept_id, event_type AS concept_name, n_cases, total_events,
  ROUND(med, 6) AS median_days_before_index, ROW_NUMBER() OVER (PARTITION BY win ORDER BY n_cases DESC, total_events DESC, event_type) AS rank FROM g""",
)
def activity_profile(lens: Lens) -> DataFrame:
    ev = lens.table("events").select(
        F.col("user_id").cast("string").alias("person_id"),
        F.col("event_type").alias("concept_id"),
        F.col("event_type").alias("concept_name"),
        F.col("ts").cast("date").alias("event_date"),
    )
    cases = ev.filter(F.col("concept_id") == "error").groupBy("person_id").agg(F.min("event_date").alias("index_date"))
    return profile.top_concepts(
        profile.preindex_events(ev, cases), "activity", [("3d", 3), ("7d", 7), ("any_prior", None)], 10
    )
