"""Tiered cohort, denominators, anchored windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casewright.operators import anchors, cohort
from casewright.operators.predicates import rule_matches, with_concept_names, tag_events, value_at_least
from casewright.plans.registry import query
from casewright.rules import Concepts, Evidence, Reading, Tier
from casewright.sources.lens import COFACTORS, RULES, Lens

NAMES = RULES.cofactor_names


def tiered(lens: Lens) -> DataFrame:
    return cohort.build_cohort(
        lens.demographics,
        lens.observation_period,
        lens.condition,
        lens.measurement,
        RULES,
        ancestry=lens.ancestry,
    )


# Tier logic as SQL, shared by the oracles below.
TIER_SQL = """
, mode AS (SELECT MAX(CASE WHEN source_vocabulary LIKE 'ICD%' THEN 1 ELSE 0 END) AS icd FROM condition),
denom AS (
  SELECT person_id, COUNT(DISTINCT event_date) AS condition_dates
  FROM condition, mode WHERE icd = 0 OR source_vocabulary LIKE 'ICD%' GROUP BY 1
),
broad AS (SELECT person_id, MIN(event_date) AS cond FROM condition WHERE concept_id IN (3,4,5) GROUP BY 1),
ck AS (SELECT person_id, event_date, value FROM measurement WHERE concept_id < 4 AND value >= 45),
definite AS (
  SELECT b.person_id, MIN(b.cond) AS cond, MIN(ck.event_date) AS meas, MAX(ck.value) AS meas_value
  FROM broad b JOIN ck ON b.person_id = ck.person_id
  WHERE date_diff('day', b.cond, ck.event_date) BETWEEN -30 AND 365 GROUP BY 1
),
high AS (SELECT person_id, MIN(event_date) AS high_date, MAX(value) AS high_value FROM ck GROUP BY 1),
excl AS (SELECT DISTINCT person_id FROM condition WHERE concept_id = 99),
tiered0 AS (
  SELECT p.*, o.obs_start_date, o.obs_end_date, COALESCE(d.condition_dates, 0) AS condition_dates,
    COALESCE(d.condition_dates, 0) >= 2 AS eligible,
    b.cond AS broad_date, f.meas AS definite_meas, f.meas_value, f.cond AS definite_date,
    h.high_date, h.high_value, e.person_id IS NOT NULL AS excluded,
    date_diff('day', o.obs_start_date, o.obs_end_date) AS observation_days
  FROM person p LEFT JOIN obs o USING (person_id) LEFT JOIN denom d USING (person_id)
  LEFT JOIN broad b USING (person_id) LEFT JOIN definite f USING (person_id)
  LEFT JOIN high h USING (person_id) LEFT JOIN excl e USING (person_id)
),
tiered AS (
  SELECT *, CASE WHEN eligible AND broad_date IS NOT NULL THEN 1 ELSE 0 END AS broad_case,
    CASE WHEN eligible AND broad_date IS NOT NULL AND definite_date IS NOT NULL THEN 1 ELSE 0 END AS definite_case,
    CASE WHEN NOT eligible THEN 'excluded_denominator'
      WHEN broad_date IS NOT NULL AND definite_date IS NOT NULL THEN 'definite'
      WHEN broad_date IS NOT NULL THEN 'broad'
      WHEN high_date IS NOT NULL THEN 'indeterminate_ck_only' ELSE 'control' END AS case_tier,
    broad_date AS index_date,
    CASE WHEN broad_date IS NOT NULL THEN CAST(YEAR(broad_date) AS DOUBLE) - year_of_birth END AS age_at_index
  FROM tiered0
),
cohort AS (
  SELECT *, CASE WHEN case_tier = 'control' AND NOT excluded AND COALESCE(observation_days, -1) >= 180
    THEN 1 ELSE 0 END AS eligible_control FROM tiered
)
"""


@query(
    "cohort_tier_counts",
    TIER_SQL + "SELECT case_tier, COUNT(*) AS n, SUM(eligible_control) AS eligible_controls FROM cohort GROUP BY 1",
)
def tier_counts(lens: Lens) -> DataFrame:
    return tiered(lens).groupBy("case_tier").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("eligible_control").cast("long")).alias("eligible_controls")
    )


@query(
    "cohort_rows",
    TIER_SQL
    + """SELECT person_id, case_tier, broad_case, definite_case, CAST(index_date AS VARCHAR) AS index_date,
  CAST(high_date AS VARCHAR) AS high_measurement_date, high_value AS high_measurement_value,
  CAST(definite_meas AS VARCHAR) AS definite_measurement_date, meas_value AS definite_measurement_value,
  condition_dates, observation_days, age_at_index, eligible_control, is_female, ancestry_pred, ROUND(pc1, 6) AS pc1
FROM cohort""",
)
def cohort_rows(lens: Lens) -> DataFrame:
    return tiered(lens).select(
        "person_id", "case_tier", "broad_case", "definite_case", "index_date", "high_measurement_date",
        "high_measurement_value", "definite_measurement_date", "definite_measurement_value", "condition_dates",
        "observation_days", "age_at_index", "eligible_control", "is_female", "ancestry_pred", "pc1",
    )


@query(
    "cohort_qc_summary",
    TIER_SQL
    + """SELECT 'n_people' AS metric, COUNT(*) AS n FROM cohort
UNION ALL SELECT 'eligible_denominator', COUNT(*) FILTER (WHERE eligible) FROM cohort
UNION ALL SELECT 'broad_cases', SUM(broad_case) FROM cohort
UNION ALL SELECT 'definite_cases', SUM(definite_case) FROM cohort
UNION ALL SELECT 'eligible_controls', SUM(eligible_control) FROM cohort
UNION ALL SELECT 'tier_' || t, (SELECT COUNT(*) FROM cohort WHERE case_tier = t)
FROM (VALUES ('definite'), ('broad'), ('indeterminate_ck_only'), ('control'), ('excluded_denominator')) v(t)""",
)
def qc_summary(lens: Lens) -> DataFrame:
    return cohort.cohort_qc(tiered(lens))


@query("observation_windows", "SELECT person_id, CAST(obs_start_date AS VARCHAR) AS obs_start_date, CAST(obs_end_date AS VARCHAR) AS obs_end_date FROM obs")
def windows(lens: Lens) -> DataFrame:
    return cohort.observation_windows(lens.observation_period)


@query(
    "denominator_counts",
    TIER_SQL
    + """SELECT person_id, condition_dates, CASE WHEN icd = 1 THEN 'icd_source_condition_records' ELSE 'all_condition_records' END
  AS condition_record_source, CAST(condition_dates >= 2 AS INT) AS eligible_denominator FROM denom, mode""",
)
def denominators(lens: Lens) -> DataFrame:
    return cohort.denominator_counts(lens.condition)


@query(
    "baseline_demographics",
    """SELECT person_id, CAST(obs_start_date AS VARCHAR) AS obs_start_date, CAST(obs_end_date AS VARCHAR) AS obs_end_date,
  year_of_birth, COALESCE(sex, 'missing') AS sex_category, is_female FROM person LEFT JOIN obs USING (person_id)""",
)
def baseline(lens: Lens) -> DataFrame:
    return cohort.baseline_frame(lens.demographics, cohort.observation_windows(lens.observation_period)).select(
        "person_id", "obs_start_date", "obs_end_date", "year_of_birth", "sex_category", "is_female"
    )


@query(
    "tier_hits_both_in_window",
    TIER_SQL
    + """SELECT person_id, CAST(cond AS VARCHAR) AS condition_date, CAST(meas AS VARCHAR) AS measurement_date,
  meas_value AS measurement_value FROM definite""",
)
def hits_both(lens: Lens) -> DataFrame:
    return cohort.tier_hits(lens.condition, lens.measurement, RULES.definite)


@query(
    "tier_hits_either",
    """, c AS (SELECT person_id, MIN(event_date) AS cond FROM condition WHERE concept_id = 7 OR contains(lower(concept_name), '1-urgent-8') GROUP BY 1),
m AS (SELECT person_id, MIN(event_date) AS meas, MAX(value) AS v FROM measurement WHERE concept_id = 2 AND value >= 49 GROUP BY 1)
SELECT COALESCE(c.person_id, m.person_id) AS person_id, CAST(cond AS VARCHAR) AS condition_date,
  CAST(meas AS VARCHAR) AS measurement_date, v AS measurement_value FROM c FULL JOIN m ON c.person_id = m.person_id""",
)
def hits_either(lens: Lens) -> DataFrame:
    rule = Tier(Evidence.EITHER, Concepts((7,), ("1-URGENT-8",)), Reading(Concepts((2,)), 49.0))
    return cohort.tier_hits(lens.condition, lens.measurement, rule)


@query(
    "tier_hits_measurement_only",
    TIER_SQL + "SELECT person_id, CAST(NULL AS VARCHAR) AS condition_date, CAST(high_date AS VARCHAR) AS measurement_date, high_value AS measurement_value FROM high",
)
def hits_measurement(lens: Lens) -> DataFrame:
    return cohort.tier_hits(lens.condition, lens.measurement, RULES.lab_alone)


@query(
    "concept_lookup",
    """, concept AS (SELECT p_partkey AS concept_id, p_name AS concept_name FROM part WHERE p_partkey % 7 <> 3)
SELECT c.person_id, c.concept_id, k.concept_name, CAST(c.event_date AS VARCHAR) AS event_date, CASE WHEN contains(lower(k.concept_name), 'red') THEN 1 ELSE 0 END AS term_hit
FROM condition c LEFT JOIN concept k USING (concept_id)""",
)
def concept_lookup(lens: Lens) -> DataFrame:
    """Events with ids only get their names from a concept table, part names here, before a term rule reads them."""
    concepts = lens.table("part").filter("p_partkey % 7 <> 3").select(F.col("p_partkey").alias("concept_id"), F.col("p_name").alias("concept_name"))
    named = with_concept_names(lens.condition, concepts)
    return named.select("person_id", "concept_id", "concept_name", "event_date", rule_matches(Concepts(terms=("RED",))).alias("term_hit"))


COFACTOR_SQL = """
, cof(cofactor, concept_id) AS (VALUES ('crush_injury', 11), ('sepsis', 12), ('renal_injury', 13)),
cofevents AS (SELECT DISTINCT person_id, cofactor, event_date FROM condition JOIN cof USING (concept_id))
"""


@query(
    "cofactor_events",
    COFACTOR_SQL + "SELECT person_id, cofactor, CAST(event_date AS VARCHAR) AS event_date FROM cofevents",
)
def cofactor_events(lens: Lens) -> DataFrame:
    return cohort.cofactor_events(lens.condition, RULES)


@query(
    "cofactor_ever_flags",
    COFACTOR_SQL
    + "SELECT person_id, "
    + ", ".join(f"MAX(CASE WHEN cofactor = '{n}' THEN 1 ELSE 0 END) AS {n}" for n in NAMES)
    + " FROM cofevents GROUP BY 1",
)
def ever_flags(lens: Lens) -> DataFrame:
    return cohort.cofactor_ever(cohort.cofactor_events(lens.condition, RULES), RULES)


@query(
    "merged_ever_flags",
    COFACTOR_SQL
    + ", tabl AS (SELECT person_id, CASE WHEN is_female = 1 THEN 1 ELSE 0 END AS sepsis FROM person), ev AS (SELECT person_id, "
    + ", ".join(f"MAX(CASE WHEN cofactor = '{n}' THEN 1 ELSE 0 END) AS {n}" for n in NAMES)
    + """ FROM cofevents GROUP BY 1)
SELECT COALESCE(t.person_id, ev.person_id) AS person_id, COALESCE(ev.crush_injury, 0) AS crush_injury,
  GREATEST(COALESCE(t.sepsis, 0), COALESCE(ev.sepsis, 0)) AS sepsis, COALESCE(ev.renal_injury, 0) AS renal_injury
FROM tabl t FULL JOIN ev ON t.person_id = ev.person_id""",
)
def merged_flags(lens: Lens) -> DataFrame:
    table = lens.person.select("person_id", (F.col("sex") == "female").cast("int").alias("sepsis"))
    ever = cohort.cofactor_ever(cohort.cofactor_events(lens.condition, RULES), RULES)
    return cohort.merge_ever_flags(table, ever, NAMES).select("person_id", *NAMES)


def _anchored_sql(n: str) -> str:
    d = f"CASE WHEN e.cofactor = '{n}' THEN date_diff('day', c.index_date, e.event_date) END"
    parts = {
        "remote_preindex": f"{d} < -30",
        "near_preindex": f"{d} BETWEEN -30 AND -8",
        "preindex": f"{d} < -7",
        "periindex": f"{d} BETWEEN -7 AND 45",
        "postindex": f"{d} > 45",
    }
    cols = [f"MAX(CASE WHEN e.cofactor = '{n}' THEN 1 ELSE 0 END) AS {n}"]
    cols += [f"MAX(CASE WHEN {p} THEN 1 ELSE 0 END) AS {k}_{n}" for k, p in parts.items()]
    return ", ".join(cols)


@query(
    "anchored_cofactor_flags",
    TIER_SQL
    + COFACTOR_SQL
    + "SELECT c.person_id, "
    + ", ".join(_anchored_sql(n) for n in NAMES)
    + " FROM cohort c LEFT JOIN cofevents e ON c.person_id = e.person_id GROUP BY 1",
)
def anchored(lens: Lens) -> DataFrame:
    columns = [c for n in NAMES for c in (n, *[f"{p}_{n}" for p in anchors.ANCHORED_PREFIXES])]
    return tiered(lens).select("person_id", *columns)


@query(
    "event_tagging",
    """SELECT person_id, CAST(event_date AS VARCHAR) AS event_date, 'heat' AS event FROM condition WHERE concept_id IN (1, 2) OR contains(lower(concept_name), 'high-3')
UNION ALL SELECT person_id, CAST(event_date AS VARCHAR), 'exertion' FROM condition WHERE concept_id IN (2, 3)""",
)
def tagging(lens: Lens) -> DataFrame:
    rules = [Concepts((1, 2), ("HIGH-3",), label="heat"), Concepts((2, 3), label="exertion")]
    return tag_events(lens.condition, rules).select("person_id", "event_date", "event")


@query(
    "measurement_threshold",
    "SELECT concept_id, COUNT(*) AS n, MIN(value) AS lowest FROM measurement WHERE value >= 45 GROUP BY 1",
)
def threshold(lens: Lens) -> DataFrame:
    return (
        lens.measurement.filter(value_at_least(F.col("value"), 45.0))
        .groupBy("concept_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lowest"))
    )


@query(
    "nearest_lab_as_of",
    TIER_SQL
    + """, ranked AS (
  SELECT b.person_id, m.event_date, m.value, abs(date_diff('day', b.cond, m.event_date)) AS dist,
    ROW_NUMBER() OVER (PARTITION BY b.person_id ORDER BY abs(date_diff('day', b.cond, m.event_date)), m.event_date) AS rn
  FROM broad b JOIN (SELECT person_id, event_date, MAX(value) AS value FROM measurement GROUP BY 1, 2) m
    ON b.person_id = m.person_id AND date_diff('day', b.cond, m.event_date) BETWEEN -90 AND 365)
SELECT b.person_id, CAST(b.cond AS VARCHAR) AS index_date, CAST(r.event_date AS VARCHAR) AS nearest_date,
  r.value AS nearest_value, r.dist AS nearest_distance
FROM broad b LEFT JOIN ranked r ON b.person_id = r.person_id AND r.rn = 1""",
)
def nearest_lab(lens: Lens) -> DataFrame:
    index = cohort.tier_hits(lens.condition, lens.measurement, RULES.broad).select(
        "person_id", F.col("condition_date").alias("index_date")
    )
    return anchors.nearest_in_window(index, lens.measurement, "index_date", -90, 365)


@query(
    "first_event_in_range",
    """, rng AS (SELECT person_id, obs_start_date + 365 AS lo, obs_start_date + 1095 AS hi FROM obs)
SELECT r.person_id, CAST(lo AS VARCHAR) AS lo, CAST(hi AS VARCHAR) AS hi,
  CAST((SELECT MIN(c.event_date) FROM condition c WHERE c.person_id = r.person_id AND c.event_date > lo AND c.event_date <= hi) AS VARCHAR) AS first_date
FROM rng r""",
)
def first_in_range(lens: Lens) -> DataFrame:
    rows = cohort.observation_windows(lens.observation_period).select(
        "person_id",
        F.date_add("obs_start_date", 365).alias("lo"),
        F.date_add("obs_start_date", 1095).alias("hi"),
    )
    return anchors.first_event_between(rows, lens.condition, "lo", "hi", "first_date", open_start=True)


_PRIOR_CASES = ", ".join(
    f"COUNT(*) FILTER (WHERE d >= {lo}{'' if hi is None else f' AND d <= {hi}'}) AS b{i}"
    for i, (_, lo, hi) in enumerate(anchors.PRIOR_BINS)
)
_PRIOR_BINS_VALUES = ", ".join(f"({i + 1}, '{t}')" for i, (t, _, _) in enumerate(anchors.PRIOR_BINS))


@query(
    "prior_event_timing",
    TIER_SQL
    + COFACTOR_SQL
    + f""", cs AS (SELECT person_id, index_date FROM cohort WHERE broad_case = 1),
nearest AS (SELECT c.person_id, e.cofactor, MIN(date_diff('day', e.event_date, c.index_date)) AS d
  FROM cs c JOIN cofevents e ON c.person_id = e.person_id AND e.event_date <= c.index_date GROUP BY 1, 2),
agg AS (SELECT n.cofactor, COUNT(d) AS n_any, quantile_cont(d, 0.5) AS md, quantile_cont(d, 0.25) AS q1, quantile_cont(d, 0.75) AS q3, {_PRIOR_CASES}
  FROM (SELECT DISTINCT cofactor FROM cof) n LEFT JOIN nearest USING (cofactor) GROUP BY 1),
bins(bin_order, timing_bin) AS (VALUES (0, 'any_prior'), {_PRIOR_BINS_VALUES}),
tot AS (SELECT COUNT(*) AS n_cases FROM cs),
lng AS (SELECT cofactor, bin_order, timing_bin, n_cases, n_any, md, q1, q3,
  CASE bin_order WHEN 0 THEN n_any WHEN 1 THEN b0 WHEN 2 THEN b1 WHEN 3 THEN b2 WHEN 4 THEN b3 WHEN 5 THEN b4 ELSE b5 END AS n
  FROM agg, bins, tot)
SELECT cofactor, bin_order, timing_bin, n, n_cases, ROUND(n * 100.0::DOUBLE / NULLIF(n_cases, 0), 6) AS pct_of_cases,
  ROUND(n * 100.0::DOUBLE / NULLIF(n_any, 0), 6) AS pct_of_any,
  CASE WHEN bin_order = 0 THEN ROUND(md, 6) END AS median_days, CASE WHEN bin_order = 0 THEN ROUND(q1, 6) END AS q1_days,
  CASE WHEN bin_order = 0 THEN ROUND(q3, 6) END AS q3_days FROM lng""",
)
def prior_timing(lens: Lens) -> DataFrame:
    cases = tiered(lens).filter(F.col("broad_case") == 1)
    return anchors.prior_timing_summary(cases, cohort.cofactor_events(lens.condition, RULES), NAMES)


_TIMING_VALUES = ", ".join(f"({i}, '{t}', {lo}, {hi})" for i, (t, lo, hi) in enumerate(anchors.TIMING_BINS))


@query(
    "presentation_timing_bins",
    TIER_SQL
    + COFACTOR_SQL
    + f""", people AS (
  SELECT person_id, CASE WHEN broad_case = 1 THEN 'cases' ELSE 'controls' END AS "group",
    CASE WHEN broad_case = 1 THEN index_date ELSE obs_start_date + 730 END AS index_date FROM cohort
  WHERE broad_case = 1 OR eligible_control = 1),
bins(bin_order, timing_bin, lo, hi) AS (VALUES {_TIMING_VALUES}),
hits AS (SELECT "group", cofactor, timing_bin, COUNT(DISTINCT p.person_id) AS n FROM people p JOIN cofevents e USING (person_id)
  JOIN bins ON date_diff('day', p.index_date, e.event_date) BETWEEN lo AND hi GROUP BY 1, 2, 3),
den AS (SELECT "group", COUNT(DISTINCT person_id) AS denominator FROM people WHERE index_date IS NOT NULL GROUP BY 1)
SELECT g."group", c.cofactor, b.bin_order, b.timing_bin, COALESCE(h.n, 0) AS n, COALESCE(denominator, 0) AS denominator,
  ROUND(COALESCE(h.n, 0) * 100.0::DOUBLE / denominator, 6) AS percent
FROM (VALUES ('cases'), ('controls')) g("group") CROSS JOIN (SELECT DISTINCT cofactor FROM cof) c CROSS JOIN bins b
LEFT JOIN den ON den."group" = g."group"
LEFT JOIN hits h ON h."group" = g."group" AND h.cofactor = c.cofactor AND h.timing_bin = b.timing_bin""",
)
def presentation_timing(lens: Lens) -> DataFrame:
    c = tiered(lens).filter((F.col("broad_case") == 1) | F.col("eligible_control"))
    model_input = c.select(
        "person_id",
        F.col("broad_case").alias("analysis_case"),
        F.when(F.col("broad_case") == 1, F.col("index_date"))
        .otherwise(F.date_add("obs_start_date", 730))
        .alias("index_date"),
    )
    return anchors.timing_histogram(model_input, cohort.cofactor_events(lens.condition, RULES), NAMES)


@query(
    "wgs_restricted_base",
    "SELECT person_id, sex FROM person WHERE has_wgs = 1",
)
def wgs_base(lens: Lens) -> DataFrame:
    flags = lens.person.select("person_id", "has_wgs")
    return cohort.restrict_to_flagged(lens.demographics, flags).select("person_id", "sex")
