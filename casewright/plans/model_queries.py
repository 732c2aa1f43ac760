"""Matching, splits, descriptive tables, scores, models and diagnostics."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from casewright.operators import anchors, cohort, describe, genotypes, incident, matching, metrics, models, samples, scores, sparse_model, splits
from casewright.operators.ranking import global_rank
from casewright.plans import drivers
from casewright.plans.cohort_queries import COFACTOR_SQL, TIER_SQL, _anchored_sql, tiered
from casewright.plans.genotype_queries import QC, SAMPLE_SQL, STATS_SQL, called, fisher_sql, flagged, sample, sample_calls
from casewright.plans.fit_sql import METRIC_ROW, formatted_sql, greedy_sql, metrics_sql, model_sql, newton_sql, tail_sql, two_group_sql
from casewright.plans.incident_queries import INCIDENT_SQL, cohort as incident_cohort
from casewright.plans.registry import query
from casewright.rules import Controls
from casewright.session import cut_lineage
from casewright.sources.lens import MATCHING, RULES, Lens

NAMES = RULES.cofactor_names
ANCHORED = [c for n in NAMES for c in (n, *[f"{p}_{n}" for p in anchors.ANCHORED_PREFIXES])]


def analysis(lens: Lens) -> DataFrame:
    """Cases and eligible controls grouped by birth year and sex, a stand-in for match groups with an oracle."""
    c = tiered(lens).filter((F.col("broad_case") == 1) | F.col("eligible_control"))
    return cut_lineage(
        c.withColumns(
            {
                "analysis_case": F.col("broad_case"),
                "match_group_id": F.concat_ws("-", F.col("year_of_birth").cast("int").cast("string"), "sex_category"),
                "eligible_control": F.col("eligible_control").cast("int"),
            }
        )
    )


def split_rows(lens: Lens) -> DataFrame:
    return splits.eligibility_flags(splits.group_splits(analysis(lens)))


SPLIT_SQL = (
    TIER_SQL
    + COFACTOR_SQL
    + ", flg AS (SELECT c.person_id, "
    + ", ".join(_anchored_sql(n) for n in NAMES)
    + """ FROM cohort c LEFT JOIN cofevents e ON c.person_id = e.person_id GROUP BY 1),
an AS (SELECT c.*, broad_case AS analysis_case, COALESCE(sex, 'missing') AS sex_category,
  CAST(CAST(year_of_birth AS INT) AS VARCHAR) || '-' || COALESCE(sex, 'missing') AS match_group_id, """
    + ", ".join(ANCHORED)
    + """ FROM cohort c JOIN flg USING (person_id) WHERE broad_case = 1 OR eligible_control = 1),
gr AS (SELECT g, ROW_NUMBER() OVER (ORDER BY substr(sha256(g), 1, 16), g) AS rk, COUNT(*) OVER () AS total FROM (SELECT DISTINCT match_group_id AS g FROM an)),
gt AS (SELECT *, CASE WHEN total <= 1 THEN 0 ELSE LEAST(GREATEST(1, CAST(round_even(CAST(total AS DOUBLE) * 0.19999999999999996::DOUBLE, 0) AS BIGINT)), total - 1) END AS nt FROM gr),
gs AS (SELECT g, CASE WHEN rk <= nt THEN 'test' ELSE 'train' END AS analysis_split, CASE WHEN rk > nt THEN (rk - nt - 1) % LEAST(5, total - nt) + 1 END AS cv_fold FROM gt),
mcase AS (SELECT match_group_id, MAX(GREATEST(preindex_crush_injury, periindex_crush_injury)) AS mc_crush, MAX(preindex_sepsis) AS mc_pre, MAX(periindex_sepsis) AS mc_peri
  FROM an WHERE analysis_case = 1 GROUP BY 1),
sp0 AS (SELECT an.*, analysis_split, cv_fold, GREATEST(preindex_crush_injury, periindex_crush_injury) AS row_crush,
  COALESCE(mc_crush, 0) AS mc_crush, COALESCE(mc_pre, 0) AS mc_pre, COALESCE(mc_peri, 0) AS mc_peri,
  CASE WHEN age_at_index IS NOT NULL AND observation_days IS NOT NULL THEN 1 ELSE 0 END AS core
  FROM an JOIN gs ON gs.g = an.match_group_id LEFT JOIN mcase USING (match_group_id)),
sp AS (SELECT *, CASE WHEN row_crush = 0 AND mc_crush = 0 AND core = 1 THEN 1 ELSE 0 END AS prim,
  CASE WHEN row_crush = 0 AND mc_crush = 0 AND core = 1 AND periindex_sepsis = 0 AND mc_peri = 0 THEN 1 ELSE 0 END AS nosep FROM sp0)
"""
)


@query("group_splits", SPLIT_SQL + "SELECT person_id, match_group_id, analysis_split, cv_fold FROM sp")
def group_splits(lens: Lens) -> DataFrame:
    return splits.group_splits(analysis(lens)).select("person_id", "match_group_id", "analysis_split", "cv_fold")


@query(
    "stratified_splits",
    INCIDENT_SQL
    + """, rk AS (SELECT person_id, analysis_case, ROW_NUMBER() OVER (PARTITION BY analysis_case ORDER BY substr(sha256(person_id), 1, 16), person_id) AS r,
  COUNT(*) OVER (PARTITION BY analysis_case) AS total FROM inc_elig),
rt AS (SELECT *, CASE WHEN total <= 1 THEN 0 ELSE LEAST(GREATEST(1, CAST(round_even(CAST(total AS DOUBLE) * 0.19999999999999996::DOUBLE, 0) AS BIGINT)), total - 1) END AS nt FROM rk)
SELECT person_id, analysis_case, CASE WHEN r <= nt THEN 'test' ELSE 'train' END AS analysis_split, CASE WHEN r > nt THEN (r - nt - 1) % 5 + 1 END AS cv_fold FROM rt""",
)
def stratified(lens: Lens) -> DataFrame:
    people = incident.case_control_rows(incident_cohort(lens), "person_id", "analysis_case")
    return splits.stratified_splits(people, stored=True)


_SUMMARY = "COUNT(*) AS n_rows, COUNT(DISTINCT match_group_id) AS n_match_groups, SUM(analysis_case) AS n_cases, SUM(1 - analysis_case) AS n_controls, CASE WHEN SUM(analysis_case) > 0 THEN printf('%.2f', CAST(SUM(1 - analysis_case) AS DOUBLE) / SUM(analysis_case)) ELSE '' END AS controls_per_case"


@query(
    "split_summary",
    SPLIT_SQL
    + f"""SELECT 'all' AS "group", {_SUMMARY} FROM sp UNION ALL SELECT analysis_split, {_SUMMARY} FROM sp GROUP BY 1
UNION ALL SELECT 'train_cv_fold_' || cv_fold, {_SUMMARY} FROM sp WHERE cv_fold IS NOT NULL GROUP BY 1""",
)
def split_summary(lens: Lens) -> DataFrame:
    return splits.split_summary(splits.group_splits(analysis(lens)))


@query(
    "eligibility_flags",
    SPLIT_SQL
    + """SELECT person_id, row_crush AS row_preperi_crush_injury, mc_crush AS matched_case_preperi_crush_injury, mc_pre AS matched_case_preindex_sepsis,
  mc_peri AS matched_case_periindex_sepsis, core AS clinical_model_complete_core, prim AS primary_model_eligible, nosep AS sensitivity_no_periindex_sepsis_eligible FROM sp""",
)
def eligibility(lens: Lens) -> DataFrame:
    return split_rows(lens).select(
        "person_id", "row_preperi_crush_injury", "matched_case_preperi_crush_injury", "matched_case_preindex_sepsis",
        "matched_case_periindex_sepsis", "clinical_model_complete_core", "primary_model_eligible",
        "sensitivity_no_periindex_sepsis_eligible",
    )


def _elig_select(label: str, flag: str, split: str, where: str) -> str:
    return f"""SELECT '{label}' AS eligibility_set, '{split}' AS split, COUNT(*) FILTER (WHERE {flag} = 1) AS n_rows,
  COUNT(DISTINCT CASE WHEN {flag} = 1 THEN match_group_id END) AS n_match_groups, COUNT(*) FILTER (WHERE {flag} = 1 AND analysis_case = 1) AS n_cases,
  COUNT(*) FILTER (WHERE {flag} = 1 AND analysis_case = 0) AS n_controls, COUNT(*) FILTER (WHERE {flag} = 0) AS excluded_rows,
  COUNT(*) FILTER (WHERE {flag} = 0 AND analysis_case = 1) AS excluded_cases, COUNT(*) FILTER (WHERE {flag} = 0 AND analysis_case = 0) AS excluded_controls,
  CASE WHEN COUNT(*) FILTER (WHERE {flag} = 1 AND analysis_case = 1) > 0 THEN printf('%.2f', CAST(COUNT(*) FILTER (WHERE {flag} = 1 AND analysis_case = 0) AS DOUBLE)
    / COUNT(*) FILTER (WHERE {flag} = 1 AND analysis_case = 1)) ELSE '' END AS controls_per_case FROM sp WHERE {where}"""


@query(
    "eligibility_summary",
    SPLIT_SQL
    + " UNION ALL ".join(
        _elig_select(label, flag, split, where)
        for label, flag in (("primary_nontraumatic", "prim"), ("sensitivity_no_periindex_sepsis", "nosep"), ("sensitivity_include_trauma", "core"))
        for split, where in (("all", "TRUE"), ("train", "analysis_split = 'train'"), ("test", "analysis_split = 'test'"))
    ),
)
def eligibility_summary(lens: Lens) -> DataFrame:
    return splits.eligibility_summary(split_rows(lens))


@query(
    "model_input_projection",
    SPLIT_SQL
    + """SELECT person_id, analysis_case, analysis_split, cv_fold, prim AS primary_model_eligible, prim AS nontraumatic_model_eligible, nosep AS sensitivity_no_periindex_sepsis_eligible,
  core AS sensitivity_include_trauma_eligible, core AS clinical_model_complete_core, eligible_control, CAST(condition_dates >= 2 AS INT) AS eligible_denominator,
  mc_crush AS matched_case_preperi_crush_injury, row_crush AS row_preperi_crush_injury, mc_pre AS matched_case_preindex_sepsis, mc_peri AS matched_case_periindex_sepsis,
  preindex_sepsis AS row_preindex_sepsis, periindex_sepsis AS row_periindex_sepsis, match_group_id, case_tier, broad_case, definite_case,
  CASE WHEN case_tier = 'indeterminate_ck_only' THEN 1 ELSE 0 END AS high_without_target, CAST(index_date AS VARCHAR) AS index_date, age_at_index, observation_days, condition_dates,
  sex_category AS model_sex_category, sex_category, is_female, ancestry_pred AS model_ancestry_pred, ancestry_pred, ROUND(pc1, 6) AS pc1, ROUND(pc2, 6) AS pc2, ROUND(pc3, 6) AS pc3,
  preindex_crush_injury, remote_preindex_sepsis, near_preindex_sepsis, preindex_sepsis, remote_preindex_renal_injury, near_preindex_renal_injury, preindex_renal_injury,
  periindex_crush_injury, periindex_sepsis, periindex_renal_injury, postindex_sepsis, postindex_renal_injury FROM sp""",
)
def model_input(lens: Lens) -> DataFrame:
    return splits.model_input(split_rows(lens))


# Matching ----------------------------------------------------------------------------------------

def matched(lens: Lens) -> DataFrame:
    return matching.match_case_controls(cut_lineage(tiered(lens)), MATCHING)


MATCH_SQL = (
    TIER_SQL
    + """, ca AS (SELECT person_id AS case_id, index_date, age_at_index, is_female, ancestry_pred FROM cohort WHERE broad_case = 1),
co AS (SELECT person_id AS control_id, is_female, ancestry_pred, obs_start_date, obs_end_date, year_of_birth,
  date_diff('day', DATE '1970-01-01', obs_start_date) + CAST(date_diff('day', obs_start_date, obs_end_date) AS DOUBLE) / 2 AS anchor FROM cohort WHERE eligible_control = 1),
near AS (SELECT COALESCE(CAST(ca.is_female AS VARCHAR), '-') || '|' || COALESCE(ca.ancestry_pred, '-') AS stratum, case_id, strftime(index_date, '%Y-%m-%d') || '|' || case_id AS case_rank, control_id,
  abs(YEAR(index_date) - year_of_birth - age_at_index) AS gap, floor(abs(anchor - date_diff('day', DATE '1970-01-01', index_date)))::DOUBLE AS dist, (YEAR(index_date) - year_of_birth)::DOUBLE AS age
  FROM ca JOIN co ON ca.is_female IS NOT DISTINCT FROM co.is_female AND ca.ancestry_pred IS NOT DISTINCT FROM co.ancestry_pred AND obs_start_date <= index_date AND obs_end_date >= index_date
  WHERE age_at_index IS NOT NULL),
cand AS (SELECT * FROM near WHERE gap <= 5 AND dist <= 730)
"""
    + greedy_sql(1)
    + """, pn AS (SELECT case_id, COUNT(*) AS k FROM pair GROUP BY 1),
mt AS (SELECT 'match-' || case_id AS match_group_id, 0 AS match_rank, 'case' AS match_role, case_id AS person_id, 1 AS analysis_case, c.index_date, c.age_at_index, k AS matched_control_count
  FROM pn JOIN cohort c ON c.person_id = case_id
  UNION ALL SELECT 'match-' || p.case_id, match_rank, 'control', control_id, 0, c.index_date, p.age, k FROM pair p JOIN pn USING (case_id) JOIN cohort c ON c.person_id = p.case_id)
"""
)


@query(
    "matched_cohort",
    MATCH_SQL
    + "SELECT match_group_id, match_rank, match_role, person_id, analysis_case, CAST(index_date AS VARCHAR) AS index_date, age_at_index, matched_control_count, CAST(matched_control_count >= 1 AS INT) AS match_complete FROM mt",
)
def matched_rows(lens: Lens) -> DataFrame:
    return matched(lens).select(
        "match_group_id", "match_rank", "match_role", "person_id", "analysis_case", "index_date", "age_at_index",
        "matched_control_count", "match_complete",
    )


@query(
    "matching_qc",
    MATCH_SQL
    + """SELECT 'matched_cases' AS metric, COUNT(*) FILTER (WHERE analysis_case = 1) AS n FROM mt UNION ALL SELECT 'matched_controls', COUNT(*) FILTER (WHERE analysis_case = 0) FROM mt
UNION ALL SELECT 'match_groups', COUNT(DISTINCT match_group_id) FROM mt""",
)
def matching_qc(lens: Lens) -> DataFrame:
    return matching.matching_qc(matched(lens))


@query(
    "matched_with_reuse",
    TIER_SQL
    + """, ca AS (SELECT person_id AS case_id, index_date, age_at_index, is_female, ancestry_pred FROM cohort WHERE broad_case = 1 AND age_at_index IS NOT NULL),
co AS (SELECT person_id AS control_id, is_female, ancestry_pred, obs_start_date, obs_end_date, year_of_birth,
  date_diff('day', DATE '1970-01-01', obs_start_date) + CAST(date_diff('day', obs_start_date, obs_end_date) AS DOUBLE) / 2 AS anchor FROM cohort WHERE eligible_control = 1),
cand AS (SELECT case_id, control_id, abs(YEAR(index_date) - year_of_birth - age_at_index) AS gap, floor(abs(anchor - date_diff('day', DATE '1970-01-01', index_date))) AS dist,
  YEAR(index_date) - year_of_birth AS age FROM ca JOIN co ON ca.is_female IS NOT DISTINCT FROM co.is_female AND ca.ancestry_pred = co.ancestry_pred
  AND obs_start_date <= index_date AND obs_end_date >= index_date),
rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY case_id ORDER BY gap, dist, control_id) AS match_rank FROM cand WHERE gap <= 5 AND dist <= 730)
SELECT case_id, control_id, match_rank, age AS age_at_case_index FROM rk WHERE match_rank <= 3""",
)
def matched_with_reuse(lens: Lens) -> DataFrame:
    rules = replace(MATCHING, controls=Controls(wanted=3, reuse=True))
    cases, controls = matching.match_inputs(cut_lineage(tiered(lens)), rules)
    return matching.assign_controls(cases, controls, rules)


# Sample restriction ------------------------------------------------------------------------------

@query(
    "id_universe_restriction",
    """, uni AS (SELECT person_id FROM person WHERE has_wgs = 1), lst AS (SELECT person_id FROM person WHERE CAST(person_id AS BIGINT) % 11 = 0)
SELECT person_id, sex FROM person SEMI JOIN uni USING (person_id) ANTI JOIN lst USING (person_id)""",
)
def id_universe(lens: Lens) -> DataFrame:
    listed = lens.person.filter(F.col("person_id").cast("long") % 11 == 0).select(F.col("person_id").alias("research_id"))
    universe = samples.id_universe(
        wgs_ids=lens.person.filter("has_wgs = 1"), listed=listed, list_name="relatedness_flagged_samples.tsv"
    )
    return samples.restrict_to_ids(lens.person, universe).select("person_id", "sex")


@query(
    "gwas_sample_funnel",
    SPLIT_SQL
    + """, w AS (SELECT sp.*, p.has_wgs FROM sp JOIN (SELECT person_id, has_wgs FROM person) p USING (person_id)),
s AS (SELECT *, analysis_split = 'train' AS s1, prim = 1 AS s2,
  (analysis_case = 1 AND broad_case = 1) OR (analysis_case = 0 AND case_tier = 'control' AND eligible_control = 1) AS s3, w.has_wgs = 1 AS s4 FROM w)
SELECT 0 AS step_order, 'input' AS step, COUNT(DISTINCT person_id) AS participants, COUNT(*) FILTER (WHERE analysis_case = 1) AS cases, COUNT(*) FILTER (WHERE analysis_case = 0) AS controls FROM s
UNION ALL SELECT 1, 'split', COUNT(DISTINCT person_id), COUNT(*) FILTER (WHERE analysis_case = 1), COUNT(*) FILTER (WHERE analysis_case = 0) FROM s WHERE s1
UNION ALL SELECT 2, 'eligibility', COUNT(DISTINCT person_id), COUNT(*) FILTER (WHERE analysis_case = 1), COUNT(*) FILTER (WHERE analysis_case = 0) FROM s WHERE s1 AND s2
UNION ALL SELECT 3, 'definition', COUNT(DISTINCT person_id), COUNT(*) FILTER (WHERE analysis_case = 1), COUNT(*) FILTER (WHERE analysis_case = 0) FROM s WHERE s1 AND s2 AND s3
UNION ALL SELECT 4, 'genotyped', COUNT(DISTINCT person_id), COUNT(*) FILTER (WHERE analysis_case = 1), COUNT(*) FILTER (WHERE analysis_case = 0) FROM s WHERE s1 AND s2 AND s3 AND s4""",
)
def gwas_sample_funnel(lens: Lens) -> DataFrame:
    rows = split_rows(lens)
    return samples.gwas_funnel(rows, lens.person.filter("has_wgs = 1"), split="train")


@query(
    "external_gwas_manifests",
    SPLIT_SQL
    + """, cc AS (SELECT person_id, CAST(analysis_case AS DOUBLE) AS analysis_case, age_at_index, is_female, ROUND(pc1, 6) AS pc1, ROUND(pc2, 6) AS pc2
FROM sp WHERE analysis_split = 'train' AND prim = 1 AND age_at_index IS NOT NULL AND is_female IS NOT NULL)
SELECT 'complete' AS frame, '0' AS FID, person_id AS IID, analysis_case, age_at_index, is_female, pc1, pc2 FROM cc
UNION ALL SELECT 'covariates', '0', person_id, NULL, age_at_index, is_female, pc1, pc2 FROM cc
UNION ALL SELECT 'phenotype', '0', person_id, analysis_case, NULL, NULL, NULL, NULL FROM cc
UNION ALL SELECT 'keep', '0', person_id, NULL, NULL, NULL, NULL, NULL FROM cc""",
)
def manifests(lens: Lens) -> DataFrame:
    rows = split_rows(lens).filter("analysis_split = 'train' and primary_model_eligible = 1")
    frames = samples.gwas_manifests(rows, ["age_at_index", "is_female", "pc1", "pc2"])
    named = [frame.withColumn("frame", F.lit(name)) for name, frame in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


@query("wgs_sample_manifest", "SELECT DISTINCT trim(person_id) AS person_id FROM person WHERE has_wgs = 1")
def wgs_manifest(lens: Lens) -> DataFrame:
    return samples.sample_manifest(lens.person, "has_wgs")


# Descriptive tables ------------------------------------------------------------------------------

BINARY = ["sepsis", "renal_injury", "preindex_sepsis", "periindex_renal_injury"]


def _binary_sql(split: str) -> str:
    parts = []
    for kind, variable, level, test in [
        *[("binary", b, "'yes'", b) for b in BINARY],
    ]:
        parts.append(
            f"SELECT {split} AS analysis_split, '{variable}' AS variable, {level} AS level, CAST(SUM(CASE WHEN analysis_case = 1 THEN {test} ELSE 0 END) AS DOUBLE) AS a, "
            f"CAST(COUNT(*) FILTER (WHERE analysis_case = 1) AS DOUBLE) AS n1, CAST(SUM(CASE WHEN analysis_case = 0 THEN {test} ELSE 0 END) AS DOUBLE) AS c, "
            f"CAST(COUNT(*) FILTER (WHERE analysis_case = 0) AS DOUBLE) AS n0 FROM sp GROUP BY 1"
        )
    for variable, col in (("sex_category", "sex_category"), ("ancestry_pred", "ancestry_pred")):
        parts.append(
            f"SELECT {split} AS analysis_split, '{variable}', {col}, CAST(COUNT(*) FILTER (WHERE analysis_case = 1) AS DOUBLE), "
            f"CAST(SUM(COUNT(*) FILTER (WHERE analysis_case = 1)) OVER (PARTITION BY {split}) AS DOUBLE), CAST(COUNT(*) FILTER (WHERE analysis_case = 0) AS DOUBLE), "
            f"CAST(SUM(COUNT(*) FILTER (WHERE analysis_case = 0)) OVER (PARTITION BY {split}) AS DOUBLE) FROM sp GROUP BY analysis_split, {col}"
        )
    return " UNION ALL ".join(parts)


@query(
    "table1_effects_by_split",
    SPLIT_SQL
    + f""", bt AS ({_binary_sql("analysis_split")}),
fx AS (SELECT *, n1 - a AS b, n0 - c AS d, CASE WHEN LEAST(a, n1 - a, c, n0 - c) = 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS f, a / n1 AS p1, c / n0 AS p0 FROM bt),
ef AS (SELECT *, CASE WHEN a = 0 AND c = 0 THEN NULL ELSE ((a + f) * (d + f)) / ((b + f) * (c + f)) END AS effect,
  sqrt(1 / (a + f) + 1 / (b + f) + 1 / (c + f) + 1 / (d + f)) AS se, sqrt((p1 * (1 - p1) + p0 * (1 - p0)) / 2) AS spread FROM fx),
ct AS (SELECT analysis_split, AVG(age_at_index) FILTER (WHERE analysis_case = 1) AS m1, AVG(age_at_index) FILTER (WHERE analysis_case = 0) AS m0,
  stddev_samp(age_at_index) FILTER (WHERE analysis_case = 1) AS s1, stddev_samp(age_at_index) FILTER (WHERE analysis_case = 0) AS s0,
  COUNT(age_at_index) FILTER (WHERE analysis_case = 1) AS n1, COUNT(age_at_index) FILTER (WHERE analysis_case = 0) AS n0 FROM sp GROUP BY 1),
oc AS (SELECT analysis_split, AVG(observation_days) FILTER (WHERE analysis_case = 1) AS m1, AVG(observation_days) FILTER (WHERE analysis_case = 0) AS m0,
  stddev_samp(observation_days) FILTER (WHERE analysis_case = 1) AS s1, stddev_samp(observation_days) FILTER (WHERE analysis_case = 0) AS s0,
  COUNT(observation_days) FILTER (WHERE analysis_case = 1) AS n1, COUNT(observation_days) FILTER (WHERE analysis_case = 0) AS n0 FROM sp GROUP BY 1)
SELECT analysis_split, variable, level, CAST(n1 AS BIGINT) AS n1, CAST(n0 AS BIGINT) AS n0, ROUND(effect, 5) AS effect,
  ROUND(CASE WHEN spread = 0 THEN 0 ELSE (p1 - p0) / spread END, 5) + 0.0::DOUBLE AS smd FROM ef
UNION ALL SELECT analysis_split, 'observation_days', '', n1, n0, ROUND(m1 - m0, 5), ROUND((m1 - m0) / sqrt((s1 * s1 + s0 * s0) / 2), 5) FROM oc
UNION ALL SELECT analysis_split, 'age_at_index', '', n1, n0, CASE WHEN n1 >= 2 AND n0 >= 2 THEN ROUND(m1 - m0, 5) END,
  CASE WHEN n1 > 0 AND n0 > 0 THEN ROUND((m1 - m0) / sqrt((s1 * s1 + s0 * s0) / 2), 5) END FROM ct""",
    decimals=5,
)
def table1_effects(lens: Lens) -> DataFrame:
    return _table1(lens).select("analysis_split", "variable", "level", "n1", "n0", "effect", "smd")


def _table1(lens: Lens) -> DataFrame:
    return describe.two_group_table(
        splits.group_splits(analysis(lens)), "analysis_case", ["age_at_index", "observation_days"], BINARY,
        ["sex_category", "ancestry_pred"], by=["analysis_split"],
    )


@query(
    "table1_formatted",
    SPLIT_SQL
    + two_group_sql("sp", "analysis_split", "analysis_case", ["age_at_index", "observation_days"], BINARY, ["sex_category", "ancestry_pred"], fisher_sql)
    + formatted_sql("analysis_split"),
)
def table1_formatted(lens: Lens) -> DataFrame:
    table = cut_lineage(describe.with_level_order(_table1(lens)))
    return describe.format_two_group(table.filter("kind <> 'categorical' or level <> ''"), ["analysis_split"])


@query(
    "categorical_balance",
    SPLIT_SQL
    + f""", bt AS ({_binary_sql("'all'")}), ag AS (SELECT variable, level, SUM(a) AS a, SUM(c) AS c FROM bt WHERE variable IN ('sex_category', 'ancestry_pred') GROUP BY 1, 2),
tt AS (SELECT *, SUM(a) OVER (PARTITION BY variable) AS n1, SUM(c) OVER (PARTITION BY variable) AS n0 FROM ag),
sm AS (SELECT *, (a + c) * n1 / (n1 + n0) AS e1, (a + c) * n0 / (n1 + n0) AS e0,
  abs((a / n1 - c / n0) / sqrt((a / n1 * (1 - a / n1) + c / n0 * (1 - c / n0)) / 2)) AS smd FROM tt)
SELECT variable, ROUND(MAX(smd), 5) AS smd, ROUND(SUM((a - e1) * (a - e1) / e1 + (c - e0) * (c - e0) / e0), 5) AS chi2 FROM sm GROUP BY 1""",
    decimals=5,
)
def categorical_balance(lens: Lens) -> DataFrame:
    table = describe.two_group_table(analysis(lens), "analysis_case", categorical=["sex_category", "ancestry_pred"])
    return describe.categorical_overall(table).select("variable", "smd", "chi2")


# The flags of the critical-illness summary, and its combined ones.
_CRIT = [
    "definite_case",
    "sepsis",
    "remote_preindex_sepsis",
    "near_preindex_sepsis",
    "preindex_sepsis",
    "periindex_sepsis",
    "postindex_sepsis",
    "renal_injury",
    "remote_preindex_renal_injury",
    "near_preindex_renal_injury",
    "preindex_renal_injury",
    "periindex_renal_injury",
    "postindex_renal_injury",
]
_CRIT_ANY = {f"{p}_sepsis_or_renal_injury": (f"{p}_sepsis", f"{p}_renal_injury") for p in ("remote_preindex", "near_preindex", "preindex", "periindex")}
# matched rows with their flags judged against the inherited index date
REANCHORED_SQL = (
    COFACTOR_SQL
    + ", mfl AS (SELECT c.match_group_id, c.match_rank, c.person_id, c.analysis_case, "
    + ", ".join(_anchored_sql(n) for n in NAMES)
    + """ FROM mt c LEFT JOIN cofevents e ON c.person_id = e.person_id GROUP BY 1, 2, 3, 4),
bfl AS (SELECT c.person_id, """
    + ", ".join(_anchored_sql(n) for n in NAMES)
    + " FROM cohort c LEFT JOIN cofevents e ON c.person_id = e.person_id GROUP BY 1)"
)


@query(
    "four_group_summary",
    MATCH_SQL
    + REANCHORED_SQL
    + f""", fu AS (SELECT 'unmatched' AS universe, broad_case, age_at_index, {', '.join(BINARY)}, COALESCE(sex, 'missing') AS sex_category, ancestry_pred FROM cohort JOIN bfl USING (person_id) WHERE eligible
  UNION ALL SELECT 'matched', m.analysis_case, m.age_at_index, {', '.join(f'b.{x}' for x in BINARY)}, COALESCE(c.sex, 'missing'), c.ancestry_pred FROM mt m JOIN cohort c USING (person_id) JOIN bfl b USING (person_id))
"""
    + two_group_sql("fu", "universe", "broad_case", ["age_at_index"], BINARY, ["sex_category", "ancestry_pred"], fisher_sql)
    + """SELECT universe, variable, level, count1, count0, ROUND(mean1, 4) AS mean1, ROUND(mean0, 4) AS mean0, ROUND(smd, 4) + 0.0 AS smd, ROUND(p_value, 4) AS p_value FROM tg""",
    decimals=4,
)
def four_group(lens: Lens) -> DataFrame:
    """Unmatched cases against non-cases beside matched cases against controls."""
    built = cut_lineage(tiered(lens))
    pairs = matching.match_case_controls(built, MATCHING)
    unmatched = built.filter("eligible_denominator").select(
        F.lit("unmatched").alias("universe"), "broad_case", "age_at_index", *BINARY, "sex_category", "ancestry_pred"
    )
    rows = unmatched.unionByName(
        pairs.select(
            F.lit("matched").alias("universe"), F.col("analysis_case").alias("broad_case"), "age_at_index", *BINARY,
            "sex_category", "ancestry_pred",
        )
    )
    table = describe.two_group_table(
        rows, "broad_case", ["age_at_index"], BINARY, ["sex_category", "ancestry_pred"], by=["universe"]
    )
    return table.select("universe", "variable", "level", "count1", "count0", "mean1", "mean0", "smd", "p_value")


@query(
    "critical_illness_summary",
    MATCH_SQL
    + REANCHORED_SQL
    + f""", g AS (SELECT 'built_broad_cases' AS grp, person_id, definite_case, {', '.join(_CRIT[1:])} FROM bfl JOIN cohort USING (person_id) WHERE broad_case = 1
  UNION ALL SELECT CASE WHEN m.analysis_case = 1 THEN 'matched_cases' ELSE 'matched_controls' END, m.person_id, c.definite_case, {', '.join(f'm.{x}' for x in _CRIT[1:])} FROM mfl m JOIN cohort c USING (person_id))
SELECT grp AS "group", 'N' AS variable, COUNT(DISTINCT person_id) AS n, CAST(NULL AS DOUBLE) AS pct FROM g GROUP BY 1
"""
    + " ".join(f"UNION ALL SELECT grp, '{c}', SUM({c}), ROUND(SUM({c}) * 100.0::DOUBLE / COUNT(*), 6) FROM g GROUP BY 1" for c in _CRIT)
    + " ".join(f" UNION ALL SELECT grp, '{k}', SUM(GREATEST({a}, {b})), ROUND(SUM(GREATEST({a}, {b})) * 100.0::DOUBLE / COUNT(*), 6) FROM g GROUP BY 1" for k, (a, b) in _CRIT_ANY.items()),
)
def critical_illness(lens: Lens) -> DataFrame:
    built = cut_lineage(tiered(lens))
    pairs = matching.match_case_controls(built, MATCHING).drop(*[c for c in ANCHORED if c not in NAMES])
    again = anchors.anchored_flags(pairs, cohort.cofactor_events(lens.condition, RULES), NAMES)
    columns = ["group", "person_id", *_CRIT]
    groups = [
        built.filter("broad_case = 1").withColumn("group", F.lit("built_broad_cases")),
        again.withColumn("group", F.when(F.col("analysis_case") == 1, "matched_cases").otherwise("matched_controls")),
    ]
    return describe.flag_summary(groups[0].select(columns).unionByName(groups[1].select(columns)), _CRIT, _CRIT_ANY)


# every model-input column that the split rows have
_MISSING = [
    "person_id", "analysis_case", "analysis_split", "cv_fold", "eligible_control", "match_group_id", "case_tier", "broad_case", "definite_case", "index_date", "age_at_index",
    "observation_days", "condition_dates", "sex_category", "is_female", "ancestry_pred", "pc1", "pc2", "pc3", *splits.MODEL_COLUMNS[-12:],
]


@query(
    "missingness_summary",
    SPLIT_SQL
    + """, g AS (SELECT *, UNNEST(['all', CASE WHEN analysis_case = 1 THEN 'cases' ELSE 'controls' END, analysis_split]) AS grp FROM sp)
"""
    + " UNION ALL ".join(
        f"SELECT '{v}' AS variable, grp AS \"group\", COUNT(*) AS n, COUNT(*) FILTER (WHERE NOT ({t})) AS observed_n, COUNT(*) FILTER (WHERE {t}) AS missing_n, "
        f"ROUND(COUNT(*) FILTER (WHERE {t}) * 100.0::DOUBLE / COUNT(*), 6) AS missing_pct FROM g GROUP BY grp"
        for v, t in {v: f"{v} IS NULL" if v != "sex_category" else "sex_category = 'missing'" for v in _MISSING}.items()
    ),
)
def missingness(lens: Lens) -> DataFrame:
    rows = splits.group_splits(analysis(lens))
    role = F.when(F.col("analysis_case") == 1, "cases").otherwise("controls")
    return describe.missingness(rows, _MISSING, F.array(F.lit("all"), role, F.col("analysis_split")))


@query(
    "missingness_report",
    SPLIT_SQL
    + " UNION ALL ".join(
        f"SELECT '{v}' AS variable, 'all' AS \"group\", COUNT(*) AS n, COUNT(*) FILTER (WHERE NOT ({t})) AS observed_n, COUNT(*) FILTER (WHERE {t}) AS missing_n, "
        f"ROUND(COUNT(*) FILTER (WHERE {t}) * 100.0::DOUBLE / COUNT(*), 6) AS missing_pct FROM sp HAVING COUNT(*) FILTER (WHERE {t}) > 0"
        for v, t in {v: f"{v} IS NULL" if v != "sex_category" else "sex_category = 'missing'" for v in _MISSING}.items()
    ),
)
def missingness_report(lens: Lens) -> DataFrame:
    rows = splits.group_splits(analysis(lens))
    return describe.filtered_missingness(describe.missingness(rows, _MISSING, F.array(F.lit("all"))))


@query(
    "consort_counts",
    MATCH_SQL
    + """SELECT 'built_rows' AS step, COUNT(*) AS n FROM cohort UNION ALL SELECT 'eligible_denominator', COUNT(*) FILTER (WHERE condition_dates >= 2) FROM cohort
UNION ALL SELECT 'broad_cases', SUM(broad_case) FROM cohort UNION ALL SELECT 'definite_cases', SUM(definite_case) FROM cohort
UNION ALL SELECT 'indeterminate_excluded', COUNT(*) FILTER (WHERE case_tier = 'indeterminate_ck_only') FROM cohort UNION ALL SELECT 'eligible_controls', COUNT(*) FILTER (WHERE eligible_control = 1) FROM cohort
UNION ALL SELECT 'matched_rows', COUNT(*) FROM mt UNION ALL SELECT 'matched_cases', COUNT(*) FILTER (WHERE analysis_case = 1) FROM mt UNION ALL SELECT 'matched_controls', COUNT(*) FILTER (WHERE analysis_case = 0) FROM mt""",
)
def consort(lens: Lens) -> DataFrame:
    built = cut_lineage(tiered(lens))
    return describe.consort(built, matching.match_case_controls(built, MATCHING))


# Scores ------------------------------------------------------------------------------------------

THRESHOLDS = [0.1, 0.5, 1.0]
WEIGHT_SQL = (
    SAMPLE_SQL
    + """, wt AS (SELECT variant_id, revel - 0.5::DOUBLE AS beta, max_af * 500.0::DOUBLE AS p, CAST(position / 10000 AS BIGINT) % 3 = 0 AS flip, revel * 0.1::DOUBLE AS mean_dosage FROM annotation),
w2 AS (SELECT *, CASE WHEN flip THEN -beta ELSE beta END AS sb FROM wt),
ths(t, threshold_label) AS (VALUES (0.1::DOUBLE, 'p0_1'), (0.5::DOUBLE, 'p0_5'), (1.0::DOUBLE, 'p1')),
cst AS (SELECT threshold_label, t, COALESCE(SUM(CASE WHEN flip AND p <= t THEN 2 * beta END), 0) AS k FROM ths, wt GROUP BY 1, 2),
sm AS (SELECT c.person_id, threshold_label, SUM(COALESCE(CAST(n_alt AS DOUBLE), mean_dosage) * sb) AS s FROM called c JOIN w2 USING (variant_id) JOIN ths ON p <= t GROUP BY 1, 2),
prs AS (SELECT q.person_id, q.outcome, cst.threshold_label, cst.t AS p_threshold, COALESCE(s, 0) + k AS prs_score FROM sampl q CROSS JOIN cst
  LEFT JOIN sm ON sm.person_id = q.person_id AND sm.threshold_label = cst.threshold_label)
"""
)


def _weights(lens: Lens) -> DataFrame:
    return lens.annotation.select(
        "variant_id",
        (F.col("revel") - 0.5).alias("beta"),
        (F.col("max_af") * 500.0).alias("p"),
        ((F.col("position") / 10000).cast("long") % 3 == 0).alias("flip"),
        (F.col("revel") * 0.1).alias("mean_dosage"),
    )


@query("prs_scores", WEIGHT_SQL + "SELECT person_id, threshold_label, p_threshold, ROUND(prs_score, 6) + 0.0::DOUBLE AS prs_score FROM prs")
def prs_scores(lens: Lens) -> DataFrame:
    return scores.person_scores(called(lens), _weights(lens), sample(lens), THRESHOLDS)


def _auc_sql(source: str, group: str) -> str:
    """CTE ``dis``: AUC and average precision per group from (grp, person_id, y, score)."""
    return f"""
, rk AS (SELECT {group} AS grp, person_id, y, score, (RANK() OVER (PARTITION BY {group} ORDER BY score) + RANK() OVER (PARTITION BY {group} ORDER BY score DESC) * -1
    + COUNT(*) OVER (PARTITION BY {group}) + 1) / 2.0::DOUBLE AS avg_rank,
  ROW_NUMBER() OVER (PARTITION BY {group} ORDER BY score DESC, person_id) AS pos,
  SUM(y) OVER (PARTITION BY {group} ORDER BY score DESC, person_id ROWS UNBOUNDED PRECEDING) AS tp FROM {source}),
dis AS (SELECT grp, COUNT(*) AS n, SUM(y) AS cases, SUM(1 - y) AS controls,
  (SUM(avg_rank * y) - SUM(y) * (SUM(y) + 1) / 2.0::DOUBLE) / NULLIF(SUM(y) * SUM(1 - y), 0) AS roc_auc,
  SUM(CASE WHEN y = 1 THEN CAST(tp AS DOUBLE) / pos END) / NULLIF(SUM(y), 0) AS average_precision FROM rk GROUP BY 1)
"""


def _per_sd_sql(source: str, keys: list[str]) -> str:
    """CTE ``psd``: OR per population SD of the score with its Wald p, by a Newton fit in each group."""
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    cols = ", ".join(keys)
    return (
        f", zz AS (SELECT {cols}, y, score - AVG(score) OVER ({part}) AS dv, stddev_pop(score) OVER ({part}) AS sd FROM {source}),\n"
        f"zrows AS (SELECT {cols}, 1.0::DOUBLE AS x0, dv / sd AS x1, y FROM zz WHERE sd > 0)"
        + newton_sql("zfit", "zrows", keys, 2, small=1e-8)
        + f", psd AS (SELECT {cols}, CASE WHEN ok THEN exp(b1) END AS or_per_score_sd, CASE WHEN ok THEN b1 END AS beta_per_score_sd, CASE WHEN ok THEN sqrt(1 / schur) END AS se_per_score_sd,"
        + f" CASE WHEN ok THEN {tail_sql('(b1 * sqrt(schur))')} END AS p_value FROM zfit)\n"
    )


@query(
    "prs_metrics",
    WEIGHT_SQL
    + ", sc AS (SELECT threshold_label, person_id, outcome AS y, ROUND(prs_score, 9) AS score FROM prs)"
    + _auc_sql("sc", "threshold_label")
    + _per_sd_sql("sc", ["threshold_label"])
    + """, g AS (SELECT threshold_label, SUM(CAST(score AS DECIMAL(18, 9))) FILTER (WHERE y = 1)::DOUBLE / COUNT(*) FILTER (WHERE y = 1) AS cm,
  SUM(CAST(score AS DECIMAL(18, 9))) FILTER (WHERE y = 0)::DOUBLE / COUNT(*) FILTER (WHERE y = 0) AS km,
  stddev_pop(score) FILTER (WHERE y = 1) AS cs, stddev_pop(score) FILTER (WHERE y = 0) AS ks FROM sc GROUP BY 1)
SELECT threshold_label, n AS n_participants, cases AS n_cases, controls AS n_controls, ROUND(roc_auc, 6) AS roc_auc, ROUND(cm, 6) AS case_mean_prs, ROUND(km, 6) AS control_mean_prs,
  ROUND(cs, 6) AS case_sd_prs, ROUND(ks, 6) AS control_sd_prs, (SELECT COUNT(*) FROM wt WHERE p <= t) AS n_variants_scored, ROUND(or_per_score_sd, 6) AS or_per_score_sd, ROUND(p_value, 6) AS p_value
FROM dis JOIN ths ON threshold_label = grp JOIN g USING (threshold_label) JOIN psd USING (threshold_label)""",
)
def prs_metrics(lens: Lens) -> DataFrame:
    people = sample(lens)
    weights = cut_lineage(_weights(lens))
    table = scores.person_scores(called(lens), weights, people, THRESHOLDS).withColumn("prs_score", F.round("prs_score", 9))
    return scores.prs_metrics(
        table, people.select("person_id", F.col("outcome").alias("analysis_case")), weights, THRESHOLDS
    ).select(
        "threshold_label", "n_participants", "n_cases", "n_controls", "roc_auc", "case_mean_prs", "control_mean_prs",
        "case_sd_prs", "control_sd_prs", "n_variants_scored", "or_per_score_sd", "p_value",
    )


@query(
    "weight_validation",
    """, raw AS (SELECT CASE WHEN p_partkey % 17 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN 'dup' || CAST(p_partkey % 5 AS VARCHAR) ELSE 'v' || CAST(p_partkey AS VARCHAR) END AS variant_id,
  CASE WHEN p_partkey % 19 = 0 THEN 'nan' ELSE 'A' END AS effect_allele, CASE WHEN p_partkey % 23 <> 0 THEN CAST(p_size AS DOUBLE) / 10.0::DOUBLE END AS beta, CAST(p_size AS DOUBLE) / 45.0::DOUBLE AS p FROM part),
ok AS (SELECT * FROM raw WHERE variant_id <> '' AND effect_allele <> 'nan' AND beta IS NOT NULL AND p BETWEEN 0 AND 1)
SELECT variant_id, effect_allele, beta, ROUND(p, 6) AS p FROM ok WHERE variant_id IN (SELECT variant_id FROM ok GROUP BY 1 HAVING COUNT(*) = 1)""",
)
def weight_validation(lens: Lens) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    raw = lens.table("part").select(
        F.when(key % 17 == 0, "").when(key % 13 == 0, F.concat(F.lit("dup"), (key % 5).cast("string"))).otherwise(F.concat(F.lit("v"), key.cast("string"))).alias("variant_id"),
        F.when(key % 19 == 0, "nan").otherwise("A").alias("effect_allele"),
        F.when(key % 23 != 0, (size / 10.0).cast("string")).otherwise("bad").alias("beta"),
        (size / 45.0).cast("string").alias("regression_p"),
    )
    return scores.valid_weights(raw)


@query(
    "ld_adjacent_r2",
    SAMPLE_SQL
    + """, pr AS (SELECT variant_id AS lead, LEAD(variant_id) OVER (PARTITION BY chromosome ORDER BY position) AS variant_id FROM annotation),
pq AS (SELECT * FROM pr WHERE variant_id IS NOT NULL), cs AS (SELECT * FROM called SEMI JOIN sampl USING (person_id)), nn AS (SELECT COUNT(*) AS n FROM sampl),
e AS (SELECT lead, pq.variant_id, COALESCE(a.person_id, b.person_id) AS person_id FROM pq JOIN cs a ON a.variant_id = pq.variant_id JOIN cs b ON b.variant_id = pq.lead AND a.person_id = b.person_id),
one AS (SELECT variant_id, person_id, n_alt FROM cs),
sgl AS (SELECT variant_id, COALESCE(SUM(n_alt), 0) AS s, COALESCE(SUM(n_alt * n_alt), 0) AS ss, COUNT(*) FILTER (WHERE n_alt IS NULL) AS m FROM one GROUP BY 1),
sh AS (SELECT e.lead, e.variant_id, SUM(x.n_alt * y.n_alt) AS xy, COUNT(*) FILTER (WHERE x.n_alt IS NULL AND y.n_alt IS NULL) AS mm,
  SUM(x.n_alt) FILTER (WHERE y.n_alt IS NULL) AS dx, SUM(x.n_alt * x.n_alt) FILTER (WHERE y.n_alt IS NULL) AS dxx,
  SUM(y.n_alt) FILTER (WHERE x.n_alt IS NULL) AS dy, SUM(y.n_alt * y.n_alt) FILTER (WHERE x.n_alt IS NULL) AS dyy
  FROM e JOIN one x ON x.variant_id = e.variant_id AND x.person_id = e.person_id JOIN one y ON y.variant_id = e.lead AND y.person_id = e.person_id GROUP BY 1, 2),
v AS (SELECT pq.lead, pq.variant_id, CAST(nn.n - COALESCE(a.m, 0) - COALESCE(b.m, 0) + COALESCE(mm, 0) AS DOUBLE) AS n, CAST(COALESCE(a.s, 0) - COALESCE(dx, 0) AS DOUBLE) AS sx,
  CAST(COALESCE(b.s, 0) - COALESCE(dy, 0) AS DOUBLE) AS sy, CAST(COALESCE(a.ss, 0) - COALESCE(dxx, 0) AS DOUBLE) AS sxx, CAST(COALESCE(b.ss, 0) - COALESCE(dyy, 0) AS DOUBLE) AS syy, CAST(COALESCE(xy, 0) AS DOUBLE) AS xy
  FROM pq CROSS JOIN nn LEFT JOIN sgl a ON a.variant_id = pq.variant_id LEFT JOIN sgl b ON b.variant_id = pq.lead LEFT JOIN sh ON sh.lead = pq.lead AND sh.variant_id = pq.variant_id)
SELECT lead, variant_id, CASE WHEN (n * sxx - sx * sx) * (n * syy - sy * sy) > 0 THEN ROUND((n * xy - sx * sy) * (n * xy - sx * sy) / ((n * sxx - sx * sx) * (n * syy - sy * sy)), 6) END AS r2 FROM v""",
)
def adjacent_r2(lens: Lens) -> DataFrame:
    people = sample(lens)
    placed = cut_lineage(
        global_rank(lens.annotation.select("variant_id", "chromosome", "position"), [F.col("position"), F.col("variant_id")], "k", ["chromosome"])
    )
    before = placed.select("chromosome", (F.col("k") + 1).alias("k"), F.col("variant_id").alias("lead"))
    pairs = placed.join(before, ["chromosome", "k"]).select("lead", "variant_id")
    calls = sample_calls(lens, people)
    return scores.pair_r2(pairs, calls, people.count())


def _gwas_weights(lens: Lens) -> DataFrame:
    return lens.annotation.select("variant_id", F.lit("A").alias("effect_allele"), (F.col("revel") - 0.5).alias("beta"), (F.col("max_af") * 500.0).alias("p"))


# r² of every pair of variants of one chromosome, over people with both calls
ALL_R2_SQL = SAMPLE_SQL + """, cs AS (SELECT variant_id, person_id, CAST(n_alt AS DOUBLE) AS x FROM called SEMI JOIN sampl USING (person_id)), nn AS (SELECT COUNT(*)::DOUBLE AS n FROM sampl),
pl AS (SELECT variant_id, chromosome, position, ROW_NUMBER() OVER (PARTITION BY chromosome ORDER BY position, variant_id) AS k FROM annotation),
sg AS (SELECT variant_id, COALESCE(SUM(x), 0) AS s, COALESCE(SUM(x * x), 0) AS ss, COUNT(*) FILTER (WHERE x IS NULL) AS m FROM cs GROUP BY 1),
sh AS (SELECT a.variant_id AS u, b.variant_id AS v, SUM(a.x * b.x) AS xy, COUNT(*) FILTER (WHERE a.x IS NULL AND b.x IS NULL) AS mm, SUM(a.x) FILTER (WHERE b.x IS NULL) AS dx,
  SUM(a.x * a.x) FILTER (WHERE b.x IS NULL) AS dxx, SUM(b.x) FILTER (WHERE a.x IS NULL) AS dy, SUM(b.x * b.x) FILTER (WHERE a.x IS NULL) AS dyy
  FROM cs a JOIN cs b ON a.person_id = b.person_id AND a.variant_id <> b.variant_id JOIN pl p ON p.variant_id = a.variant_id JOIN pl q ON q.variant_id = b.variant_id AND q.chromosome = p.chromosome GROUP BY 1, 2),
vv AS (SELECT p.variant_id AS u, q.variant_id AS v, abs(p.position - q.position) AS bp, abs(p.k - q.k) AS ranks, nn.n - COALESCE(a.m, 0) - COALESCE(b.m, 0) + COALESCE(mm, 0) AS n,
  COALESCE(a.s, 0) - COALESCE(dx, 0) AS sx, COALESCE(b.s, 0) - COALESCE(dy, 0) AS sy, COALESCE(a.ss, 0) - COALESCE(dxx, 0) AS sxx, COALESCE(b.ss, 0) - COALESCE(dyy, 0) AS syy, COALESCE(xy, 0) AS xy
  FROM pl p JOIN pl q ON p.chromosome = q.chromosome AND p.variant_id <> q.variant_id CROSS JOIN nn LEFT JOIN sg a ON a.variant_id = p.variant_id LEFT JOIN sg b ON b.variant_id = q.variant_id
  LEFT JOIN sh ON sh.u = p.variant_id AND sh.v = q.variant_id),
r2 AS (SELECT u, v, bp, ranks, CASE WHEN (n * sxx - sx * sx) * (n * syy - sy * sy) > 0 THEN (n * xy - sx * sy) * (n * xy - sx * sy) / ((n * sxx - sx * sx) * (n * syy - sy * sy)) END AS r2 FROM vv)
"""


def _select_sql(conflict: str) -> str:
    """CTE ``sel`` (chromosome, id, lead, r2): sequential greedy over ``ord`` (chromosome, id, pr, can) and conflicts in r2."""
    return f"""
, seq AS MATERIALIZED (SELECT chromosome, id, can, ROW_NUMBER() OVER (PARTITION BY chromosome ORDER BY pr, id) AS t FROM ord),
cf AS MATERIALIZED (SELECT u, list(v) AS vs FROM r2 WHERE {conflict} GROUP BY 1),
walk(chromosome, t, id, lead, kept) AS (
  SELECT DISTINCT chromosome, 0::BIGINT, NULL::VARCHAR, NULL::VARCHAR, [''] FROM seq
  UNION ALL
  SELECT chromosome, t, id, CASE WHEN first IS NOT NULL THEN first WHEN can THEN id END, CASE WHEN first IS NULL AND can THEN list_append(kept, id) ELSE kept END FROM (
    SELECT s.chromosome, s.t, s.id, s.can, w.kept, list_filter(w.kept, lambda x: list_contains(cf.vs, x))[1] AS first
    FROM walk w JOIN seq s ON s.chromosome = w.chromosome AND s.t = w.t + 1 LEFT JOIN cf ON cf.u = s.id)
)
"""


@query(
    "ld_clumps",
    ALL_R2_SQL
    + ", ord AS (SELECT chromosome, variant_id AS id, max_af * 500.0::DOUBLE AS pr, max_af * 500.0::DOUBLE <= 0.5 AS can FROM annotation WHERE max_af * 500.0::DOUBLE <= 1.0)"
    + _select_sql("bp <= 1000000 AND r2 >= 0.05")
    + "SELECT w.lead, w.id AS variant_id, CASE WHEN w.lead = w.id THEN 1.0 ELSE ROUND(r2.r2, 6) END AS r2 FROM walk w LEFT JOIN r2 ON r2.u = w.id AND r2.v = w.lead WHERE w.lead IS NOT NULL",
)
def ld_clumps(lens: Lens) -> DataFrame:
    people = sample(lens)
    calls = sample_calls(lens, people)
    return scores.clump(
        _gwas_weights(lens), lens.annotation, calls, people.count(), p1=0.5, p2=1.0, r2=0.05, kb=1000
    )


@query(
    "ld_pruned_variants",
    ALL_R2_SQL
    + """, pst AS (SELECT variant_id, 2 * (nn.n - m) AS an, s AS ac FROM sg, nn), mf AS (SELECT variant_id, LEAST(ac / an, 1.0::DOUBLE - ac / an) AS maf FROM pst),
ord AS (SELECT chromosome, variant_id AS id, -maf AS pr, TRUE AS can FROM annotation JOIN mf USING (variant_id))"""
    + _select_sql("ranks <= 4 AND r2 > 0.05")
    + "SELECT id AS variant_id FROM walk WHERE lead = id",
)
def ld_pruned(lens: Lens) -> DataFrame:
    people = sample(lens)
    calls = sample_calls(lens, people)
    stats = genotypes.variant_stats(calls, people, "outcome", stored=True).select("variant_id", "maf")
    return scores.prune(stats, lens.annotation, calls, people.count(), window_variants=5, r2=0.05)


# Score diagnostics -------------------------------------------------------------------------------

def risk_scores(lens: Lens) -> DataFrame:
    """Account balance as a risk score with tied values, outcome from the cohort, ancestry as a stratum."""
    joined = sample(lens).join(lens.person.select("person_id", "score"), "person_id")
    return joined.select(
        "person_id", F.col("outcome").alias("y"), F.round(F.col("score") / 100, 0).alias("score"), "ancestry_pred"
    )


RISK_SQL = SAMPLE_SQL + ", risk AS (SELECT s.person_id, outcome AS y, ROUND(p.score / 100, 0) AS score, s.ancestry_pred FROM sampl s JOIN person p USING (person_id))"


@query(
    "score_discrimination",
    RISK_SQL + _auc_sql("risk", "ancestry_pred")
    + "SELECT grp AS ancestry_pred, n, cases, controls, ROUND(roc_auc, 6) AS roc_auc, ROUND(average_precision, 6) AS average_precision FROM dis",
)
def score_discrimination(lens: Lens) -> DataFrame:
    return metrics.discrimination(risk_scores(lens), ["ancestry_pred"])


@query(
    "youden_threshold",
    RISK_SQL
    + """, t AS (SELECT score, SUM(SUM(y)) OVER w AS tp, SUM(SUM(1 - y)) OVER w AS fp FROM risk GROUP BY score WINDOW w AS (ORDER BY score DESC)),
m AS (SELECT MAX(tp) AS p, MAX(fp) AS n FROM t)
SELECT score AS threshold, ROUND(CAST(tp AS DOUBLE) / p - CAST(fp AS DOUBLE) / n, 6) AS youden FROM t, m ORDER BY CAST(tp AS DOUBLE) / p - CAST(fp AS DOUBLE) / n DESC, score DESC LIMIT 1""",
)
def youden(lens: Lens) -> DataFrame:
    return metrics.youden_threshold(risk_scores(lens))


@query(
    "confusion_metrics",
    RISK_SQL
    + """, c AS (SELECT COUNT(*) FILTER (WHERE score >= 50 AND y = 1) AS tp, COUNT(*) FILTER (WHERE score >= 50 AND y = 0) AS fp,
  COUNT(*) FILTER (WHERE score < 50 AND y = 0) AS tn, COUNT(*) FILTER (WHERE score < 50 AND y = 1) AS fn FROM risk)
SELECT *, ROUND(CAST(tp AS DOUBLE) / (tp + fn), 6) AS sensitivity, ROUND(CAST(tn AS DOUBLE) / (tn + fp), 6) AS specificity, ROUND(CAST(tp AS DOUBLE) / (tp + fp), 6) AS ppv,
  ROUND(CAST(tn AS DOUBLE) / (tn + fn), 6) AS npv, ROUND(CAST(tp + tn AS DOUBLE) / (tp + fp + tn + fn), 6) AS accuracy FROM c""",
)
def confusion(lens: Lens) -> DataFrame:
    return metrics.confusion(risk_scores(lens), 50.0)


_PROB_SQL = RISK_SQL + ", prob AS (SELECT person_id, y, 1.0::DOUBLE / (1.0::DOUBLE + exp(-score / 50.0::DOUBLE)) AS score FROM risk)"


def _probabilities(lens: Lens) -> DataFrame:
    return risk_scores(lens).withColumn("score", 1.0 / (1.0 + F.exp(-F.col("score") / 50.0)))


@query(
    "probability_errors",
    _PROB_SQL
    + """SELECT ROUND(AVG((score - y) * (score - y)), 6) AS brier_score, ROUND(AVG(-(y * ln(GREATEST(1e-12, LEAST(1 - 1e-12, score)))
  + (1 - y) * ln(1 - GREATEST(1e-12, LEAST(1 - 1e-12, score))))), 6) AS log_loss FROM prob""",
)
def probability_errors(lens: Lens) -> DataFrame:
    return metrics.probability_errors(_probabilities(lens))


@query(
    "calibration_equal_count",
    _PROB_SQL
    + """, b AS (SELECT *, NTILE(10) OVER (ORDER BY score, person_id) AS bin FROM prob)
SELECT bin, COUNT(*) AS n, ROUND(AVG(score), 6) AS mean_predicted_probability, ROUND(AVG(y), 6) AS observed_case_fraction FROM b GROUP BY 1""",
)
def calibration_equal(lens: Lens) -> DataFrame:
    return metrics.calibration(metrics.equal_count_bins(_probabilities(lens)))


_QBIN = "GREATEST(1, CAST(ceil((r - 1) * LEAST(10, n) / CAST(NULLIF(n - 1, 0) AS DOUBLE)) AS INT)) AS bin"


@query(
    "calibration_quantile",
    _PROB_SQL
    + f""", r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY score, person_id) AS r, COUNT(*) OVER () AS n FROM prob), b AS (SELECT *, {_QBIN} FROM r)
SELECT bin, COUNT(*) AS n, ROUND(AVG(score), 6) AS mean_predicted_probability, ROUND(AVG(y), 6) AS observed_case_fraction FROM b GROUP BY 1""",
)
def calibration_quantile(lens: Lens) -> DataFrame:
    return metrics.calibration(metrics.quantile_bins(_probabilities(lens)))


@query(
    "score_deciles",
    RISK_SQL
    + f""", r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY score, person_id) AS r, COUNT(*) OVER () AS n FROM risk), b AS (SELECT *, {_QBIN} FROM r),
g AS (SELECT bin, COUNT(*) AS n, CAST(SUM(y) AS BIGINT) AS cases, CAST(SUM(1 - y) AS BIGINT) AS controls, MIN(score) AS score_min, MAX(score) AS score_max, quantile_cont(score, 0.5) AS score_median FROM b GROUP BY 1),
rf AS (SELECT cases AS rc, controls AS rk FROM g WHERE bin = 1),
cells AS (SELECT bin AS id, g.*, cases AS a, controls AS b, rc AS c, rk AS d FROM g, rf)
"""
    + fisher_sql("cells")
    + """, o AS (SELECT cells.*, p, ((cases + 0.5) * (d + 0.5)) / CAST((controls + 0.5) * (c + 0.5) AS DOUBLE) AS odds,
  sqrt(1 / CAST(cases + 0.5 AS DOUBLE) + 1 / CAST(controls + 0.5 AS DOUBLE) + 1 / CAST(c + 0.5 AS DOUBLE) + 1 / CAST(d + 0.5 AS DOUBLE)) AS se FROM cells JOIN fish USING (id))
SELECT bin, n, cases, controls, ROUND(CAST(cases AS DOUBLE) / n, 5) AS prevalence, score_min, score_median, score_max, ROUND(odds, 5) AS odds_ratio_vs_lowest,
  ROUND(exp(ln(odds) - 1.96 * se), 5) AS or_ci_low, ROUND(exp(ln(odds) + 1.96 * se), 5) AS or_ci_high, ROUND(p, 5) AS fisher_p_vs_lowest FROM o""",
    decimals=5,
)
def deciles(lens: Lens) -> DataFrame:
    return metrics.decile_table(risk_scores(lens)).select(
        "bin", "n", "cases", "controls", "prevalence", "score_min", "score_median", "score_max", "odds_ratio_vs_lowest",
        "or_ci_low", "or_ci_high", "fisher_p_vs_lowest",
    )


@query(
    "score_group_summary",
    RISK_SQL
    + """SELECT y, COUNT(*) AS n, ROUND(AVG(score), 6) AS mean, ROUND(stddev_pop(score), 6) AS sd, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS median,
  quantile_cont(score, 0.75) AS q3 FROM risk GROUP BY 1""",
)
def group_summary(lens: Lens) -> DataFrame:
    return metrics.group_summary(risk_scores(lens), ["y"])


def _curve_sql(x: str, y: str, y0: str) -> str:
    return (
        RISK_SQL
        + f""", c AS (SELECT ROW_NUMBER() OVER w AS position, SUM(y) OVER w AS tp, SUM(1 - y) OVER w AS fp FROM risk WINDOW w AS (ORDER BY score DESC, person_id ROWS UNBOUNDED PRECEDING)),
m AS (SELECT MAX(tp) AS p, MAX(fp) AS n FROM c)
SELECT position, ROUND({x}, 6) AS x, ROUND({y}, 6) AS y FROM c, m UNION ALL SELECT 0, 0.0::DOUBLE, {y0}::DOUBLE"""
    )


@query("roc_points", _curve_sql("CAST(fp AS DOUBLE) / n", "CAST(tp AS DOUBLE) / p", "0.0"))
def roc_points(lens: Lens) -> DataFrame:
    return metrics.curve_points(risk_scores(lens), "roc")


@query("precision_recall_points", _curve_sql("CAST(tp AS DOUBLE) / p", "CAST(tp AS DOUBLE) / (tp + fp)", "1.0"))
def pr_points(lens: Lens) -> DataFrame:
    return metrics.curve_points(risk_scores(lens), "pr")


_SCORE_ROW = """n, cases, controls, ROUND(roc_auc, 6) AS roc_auc, ROUND(average_precision, 6) AS average_precision, ROUND(CAST(cases AS DOUBLE) / n, 6) AS prevalence,
  ROUND(or_per_score_sd, 6) AS or_per_score_sd, ROUND(beta_per_score_sd, 6) AS beta_per_score_sd, ROUND(se_per_score_sd, 6) AS se_per_score_sd, ROUND(p_value, 6) AS p_value"""


@query(
    "stratified_score_metrics",
    RISK_SQL + _auc_sql("risk", "ancestry_pred") + _per_sd_sql("risk", ["ancestry_pred"])
    + f"SELECT ancestry_pred, {_SCORE_ROW} FROM dis LEFT JOIN psd ON ancestry_pred = grp",
)
def stratified_metrics(lens: Lens) -> DataFrame:
    return metrics.score_metrics(risk_scores(lens), ["ancestry_pred"])


@query(
    "recalibrated_errors",
    _PROB_SQL
    + ", lrows AS (SELECT 1.0::DOUBLE AS x0, ln(LEAST(1 - 1e-6, GREATEST(1e-6, score)) / (1 - LEAST(1 - 1e-6, GREATEST(1e-6, score)))) AS x1, y FROM prob)"
    + newton_sql("lfit", "lrows", [], 2, small=1e-8)
    + """, rp AS (SELECT y, b0, b1, n, 1 / (1 + exp(-LEAST(40, GREATEST(-40, b0 + b1 * x1)))) AS q FROM lrows, lfit)
SELECT ROUND(AVG((q - y) * (q - y)), 6) AS brier_score, ROUND(AVG(-(y * ln(GREATEST(1e-12, LEAST(1 - 1e-12, q))) + (1 - y) * ln(1 - GREATEST(1e-12, LEAST(1 - 1e-12, q))))), 6) AS log_loss,
  ROUND(MAX(b0), 6) AS intercept, ROUND(MAX(b1), 6) AS slope, MAX(n) AS n FROM rp""",
)
def recalibrated(lens: Lens) -> DataFrame:
    rows = cut_lineage(_probabilities(lens))
    fit = cut_lineage(metrics.recalibration(rows))
    return metrics.probability_errors(metrics.recalibrated(rows, fit)).crossJoin(fit)


@query(
    "bootstrap_intervals",
    RISK_SQL
    # rows in the order of their cells; a draw's place is the mix of its number
    + """, bc AS (SELECT *, MIN(person_id) OVER (PARTITION BY score, y) AS first FROM risk),
bi AS (SELECT score, y, first, ROW_NUMBER() OVER (ORDER BY score DESC, first, person_id) - 1 AS i, COUNT(*) OVER () AS n FROM bc), bn AS (SELECT MAX(n) AS n FROM bi),
bx AS (SELECT id, n, ((id + 20240101)::UHUGEINT * 11400714819323198485::UHUGEINT) % 18446744073709551616::UHUGEINT AS x FROM (SELECT UNNEST(range(500 * n)) AS id, n FROM bn)),
by1 AS (SELECT id, n, (xor(x::UBIGINT, x::UBIGINT >> 30)::UHUGEINT * 13787848793156543929::UHUGEINT) % 18446744073709551616::UHUGEINT AS x FROM bx),
by2 AS (SELECT id, n, ((xor(x::UBIGINT, x::UBIGINT >> 27))::UHUGEINT * 10723151780598845931::UHUGEINT) % 18446744073709551616::UHUGEINT AS x FROM by1),
bd AS (SELECT id // n AS iteration, (xor(x::UBIGINT, x::UBIGINT >> 31) % n::UBIGINT)::BIGINT AS i FROM by2),
bs AS (SELECT iteration, first AS person_id, y, score FROM bd JOIN bi USING (i))
"""
    + _auc_sql("bs", "iteration")
    + _per_sd_sql("bs", ["iteration"])
    + """, bv AS (SELECT UNNEST(['roc_auc', 'average_precision', 'or_per_score_sd']) AS metric, UNNEST([roc_auc, average_precision, or_per_score_sd]) AS v FROM dis JOIN psd ON iteration = grp WHERE cases > 0 AND controls > 0),
bq AS (SELECT metric, quantile_cont(v, 0.025) AS ci_low, quantile_cont(v, 0.975) AS ci_high, COUNT(*) AS iterations_used FROM bv WHERE v IS NOT NULL GROUP BY 1),
one AS (SELECT 0 AS iteration, person_id, y, score FROM risk)
"""
    + _auc_sql("one", "iteration").replace(", rk AS", ", rk1 AS").replace("dis AS", "dis1 AS").replace("FROM rk GROUP", "FROM rk1 GROUP")
    + _per_sd_sql("one", ["iteration"]).replace("zz", "yy").replace("zrows", "yrows").replace("zfit", "yfit").replace("psd AS", "psd1 AS")
    + """, pt AS (SELECT UNNEST(['roc_auc', 'average_precision', 'or_per_score_sd']) AS metric, UNNEST([roc_auc, average_precision, or_per_score_sd]) AS point FROM dis1, psd1)
SELECT metric, ROUND(point, 5) AS point_estimate, ROUND(ci_low, 5) AS ci_low, ROUND(ci_high, 5) AS ci_high, iterations_used, 500 AS iterations_requested FROM pt LEFT JOIN bq USING (metric)""",
    decimals=5,
)
def bootstrap(lens: Lens) -> DataFrame:
    return metrics.bootstrap_intervals(risk_scores(lens))


# Models ------------------------------------------------------------------------------------------

CLINICAL = dict(
    continuous=[
        ("age_at_index", "age_at_index_per_sd", "identity"),
        ("observation_days", "observation_days_per_sd", "log1p"),
        ("condition_dates", "condition_dates_per_sd", "identity"),
    ],
    binary=["sepsis", "renal_injury"],
)
# Sexes and regions of the lens; the first of each is what the others are measured against.
LEVELS = [("sx", "male"), ("sx", "missing"), ("rg", "america"), ("rg", "asia"), ("rg", "europe"), ("rg", "middle east")]
NUMBERS = ["age_at_index", "ln(1 + GREATEST(observation_days, 0))", "condition_dates"]
CLINICAL_SQL = SPLIT_SQL + ", cl AS (SELECT person_id, analysis_case AS y, analysis_split, cv_fold, age_at_index, observation_days, condition_dates, sepsis, renal_injury, sex_category AS sx, lower(ancestry_pred) AS rg FROM sp)\n"
_FULL = model_sql("m", "cl", "analysis_split = 'train'", NUMBERS, CLINICAL["binary"], LEVELS)


def _coefficients_sql() -> str:
    """Feature names with their weights: the twenty largest by size."""
    names = [n for _, n, _ in CLINICAL["continuous"]] + CLINICAL["binary"] + [f"{dict(sx='model_sex_category', rg='model_ancestry_pred')[c]}={v}" for c, v in LEVELS]
    sources = [s for s, _, _ in CLINICAL["continuous"]] + CLINICAL["binary"] + [dict(sx="model_sex_category", rg="model_ancestry_pred")[c] for c, _ in LEVELS]
    kinds = ["continuous"] * 3 + ["binary"] * 2 + ["categorical"] * 6
    against = [""] * 5 + ["female"] * 2 + ["africa"] * 4
    rows = " UNION ALL ".join(f"SELECT '{n}' AS feature, '{s}' AS source_column, '{k}' AS kind, '{a}' AS reference, b{i} AS beta FROM m_f" for i, (n, s, k, a) in enumerate(zip(names, sources, kinds, against), start=1))
    return f"SELECT feature, source_column, kind, reference, ROUND(beta, 3) + 0.0 AS beta, ROUND(exp(beta), 3) AS odds_ratio FROM ({rows}) ORDER BY abs(beta) DESC, feature LIMIT 20"


def clinical_input(lens: Lens) -> DataFrame:
    rows = splits.group_splits(analysis(lens))
    return rows.select(
        "person_id", "analysis_case", "analysis_split", "cv_fold", "age_at_index", "observation_days", "condition_dates",
        "sepsis", "renal_injury", "pc1", "pc2",
        F.col("sex_category").alias("model_sex_category"), F.lower("ancestry_pred").alias("model_ancestry_pred"),
    )


@query(
    "clinical_model_metrics",
    CLINICAL_SQL + _FULL + metrics_sql("mm", "m_p", "analysis_split", "(SELECT cut FROM m_t)") + f"SELECT grp AS evaluation_set, {METRIC_ROW} FROM mm",
    decimals=4,
)
def clinical_model(lens: Lens) -> DataFrame:
    return models.run_model(clinical_input(lens), "analysis_case", CLINICAL)["metrics"].drop("threshold")


@query("clinical_model_coefficients", CLINICAL_SQL + _FULL + _coefficients_sql(), decimals=3)
def clinical_coefficients(lens: Lens) -> DataFrame:
    return models.top_coefficients(models.run_model(clinical_input(lens), "analysis_case", CLINICAL)["coefficients"])


@query(
    "clinical_model_cv",
    CLINICAL_SQL
    + "".join(
        model_sql(f"f{k}", "cl", f"analysis_split = 'train' AND cv_fold <> {k}", NUMBERS, CLINICAL["binary"], LEVELS)
        + f", h{k} AS (SELECT * FROM f{k}_p WHERE analysis_split = 'train' AND cv_fold = {k})"
        + metrics_sql(f"g{k}", f"h{k}", "cv_fold", f"(SELECT cut FROM f{k}_t)")
        for k in range(1, 6)
    )
    + " UNION ALL ".join(f"SELECT grp::INT AS fold, {METRIC_ROW}, ROUND((SELECT cut FROM f{k}_t), 4) AS threshold FROM g{k}" for k in range(1, 6)),
    decimals=4,
)
def clinical_cv(lens: Lens) -> DataFrame:
    train = cut_lineage(clinical_input(lens).filter("analysis_split = 'train'"))
    return models.cv_metrics(train, "analysis_case", CLINICAL)


# The features of the incident model, in their public order.
INCIDENT_NUMBERS = [
    "age_at_baseline",
    "prebaseline_ck_max",
    "prebaseline_creatinine_last",
    "prebaseline_ast_last",
    "prebaseline_alt_last",
    "prebaseline_sodium_last",
    "prebaseline_potassium_last",
    "prebaseline_calcium_last",
    "prebaseline_tsh_last",
]
INCIDENT_FLAGS = [
    "prior_kidney_disease_or_aki",
    "remote_sepsis_history",
    "prior_heat_illness_or_dehydration",
    "prior_exertion_or_exercise_code",
    "prior_myopathy_muscle_disease",
    "prior_sickle_trait_or_disease",
    "prior_diabetes",
    "prior_thyroid_disease",
    "prior_liver_disease",
    "prior_alcohol_substance_condition",
    "prior_injury_trauma_history",
    "ck_tested_prebaseline",
]


_INCIDENT_SPLIT_SQL = (
    INCIDENT_SQL
    + """, irk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY analysis_case ORDER BY substr(sha256(person_id), 1, 16), person_id) AS r, COUNT(*) OVER (PARTITION BY analysis_case) AS total FROM inc_elig),
irt AS (SELECT *, CASE WHEN total <= 1 THEN 0 ELSE LEAST(GREATEST(1, CAST(round_even(CAST(total AS DOUBLE) * 0.19999999999999996::DOUBLE, 0) AS BIGINT)), total - 1) END AS nt FROM irk),
ic AS (SELECT *, analysis_case AS y, CASE WHEN r <= nt THEN 'test' ELSE 'train' END AS analysis_split, COALESCE(sex, 'missing') AS sx, COALESCE(sex, 'missing') AS sex_category, lower(ancestry_pred) AS rg FROM irt)
"""
)


@query(
    "incident_table1",
    _INCIDENT_SPLIT_SQL
    + two_group_sql("ic", "analysis_split", "analysis_case", INCIDENT_NUMBERS, INCIDENT_FLAGS, ["sex_category", "ancestry_pred"], fisher_sql, null_as_zero=True)
    + formatted_sql("analysis_split"),
)
def incident_table1(lens: Lens) -> DataFrame:
    columns = dict.fromkeys(["person_id", "analysis_case", *INCIDENT_NUMBERS, *INCIDENT_FLAGS, "sex_category", "ancestry_pred"])
    people = incident.case_control_rows(incident_cohort(lens), *columns)
    # written: the table reads its rows once for each kind of line
    rows = cut_lineage(splits.stratified_splits(people, stored=True))
    return describe.format_two_group(
        describe.two_group_table(
            rows, "analysis_case", INCIDENT_NUMBERS, INCIDENT_FLAGS,
            ["sex_category", "ancestry_pred"], by=["analysis_split"], null_as_zero=True,
        ),
        ["analysis_split"],
    )


@query(
    "incident_model_metrics",
    _INCIDENT_SPLIT_SQL
    + model_sql("m", "ic", "analysis_split = 'train'", INCIDENT_NUMBERS, INCIDENT_FLAGS, LEVELS)
    + metrics_sql("mm", "m_p", "analysis_split", "(SELECT cut FROM m_t)")
    + f"SELECT grp AS evaluation_set, {METRIC_ROW} FROM mm",
    decimals=4,
)
def incident_model(lens: Lens) -> DataFrame:
    features = dict(
        continuous=[(c, f"{c}_per_sd", "identity") for c in INCIDENT_NUMBERS],
        binary=INCIDENT_FLAGS,
        min_observed=5,
    )
    return drivers.incident_model(splits.incident_model_input(incident_cohort(lens)), features, folds=False)["metrics"].drop("threshold")


_SCORES_SQL = WEIGHT_SQL.removeprefix(TIER_SQL)


@query(
    "heldout_model_comparison",
    CLINICAL_SQL
    + _SCORES_SQL
    + _FULL
    + """, ho AS (SELECT person_id, y, threshold_label, 'clinical_only' AS model, score FROM m_p JOIN prs USING (person_id) WHERE analysis_split = 'test'
  UNION ALL SELECT person_id, y, threshold_label, 'prs_only', ROUND(prs_score, 9) FROM m_p JOIN prs USING (person_id) WHERE analysis_split = 'test'),
hg AS (SELECT *, model || '|' || threshold_label AS mg FROM ho)
"""
    + _auc_sql("hg", "mg")
    + _per_sd_sql("hg", ["mg"])
    + f"SELECT split_part(grp, '|', 1) AS model, split_part(grp, '|', 2) AS threshold_label, {_SCORE_ROW.replace(', 6)', ', 4)')} FROM dis LEFT JOIN psd ON mg = grp",
    decimals=4,
)
def heldout(lens: Lens) -> DataFrame:
    fitted = models.run_model(clinical_input(lens), "analysis_case", CLINICAL)
    test = fitted["predictions"].filter("analysis_split = 'test'")
    table = scores.person_scores(called(lens), _weights(lens), test, THRESHOLDS).withColumn("prs_score", F.round("prs_score", 9))
    table = table.join(test.select("person_id", "analysis_case"), "person_id")
    rows = models.heldout_comparison(test, table)
    return metrics.score_metrics(cut_lineage(rows), ["model", "threshold_label"])


@query(
    "clinical_score_model_metrics",
    CLINICAL_SQL
    + _SCORES_SQL
    + ", cq AS (SELECT cl.*, prs_score FROM cl JOIN prs USING (person_id) WHERE threshold_label = 'p1')"
    + model_sql("m", "cq", "analysis_split = 'train'", [*NUMBERS, "prs_score"], CLINICAL["binary"], LEVELS)
    + metrics_sql("mm", "m_p", "analysis_split", "(SELECT cut FROM m_t)")
    + f"SELECT grp AS evaluation_set, {METRIC_ROW} FROM mm",
    decimals=4,
)
def clinical_score_model(lens: Lens) -> DataFrame:
    """Clinical features plus one score feature, people with a score only."""
    rows = cut_lineage(clinical_input(lens))
    table = scores.person_scores(called(lens), _weights(lens), rows, [1.0])
    return drivers.clinical_score_model(rows, table, CLINICAL, "p1", None, folds=False)["metrics"].drop("threshold", "threshold_label")


# The first steps of the path, as fractions of each fold's own top λ; oracle and query share them.
PATH_FRACTIONS, PATH_ALPHA = (1.0, 0.95, 0.9), 0.5


def _path_sql() -> str:
    """Elastic-net weights of every held-out fold by cyclic coordinate steps on a quadratic bound of the log-loss, each λ from zero.

    Variants enter that the sequential strong rule allows, with some room.
    """
    least = {"maf": "min_maf", "mac": "min_mac", "call_rate": "min_call_rate", "hwe_control_p": "min_hwe_p"}
    qc = " AND ".join(f"{c} >= {QC[name]}" for c, name in least.items())
    eta = "b0 * x0 + b1 * x1 + b2 * x2"
    return (
        SPLIT_SQL
        + """, sampl AS (SELECT person_id, analysis_case AS outcome FROM sp WHERE analysis_split = 'train'),
called AS (SELECT person_id, variant_id, CASE WHEN ft = 'PASS' THEN dosage END AS n_alt FROM genotype)
"""
        + STATS_SQL.removeprefix(SAMPLE_SQL)
        + f""", panel AS (SELECT variant_id FROM annotation JOIN stats USING (variant_id) WHERE biallelic AND {qc}),
tp AS (SELECT person_id, analysis_case AS y, cv_fold, (pc1 - AVG(pc1) OVER ()) / stddev_pop(pc1) OVER () AS c1, (pc2 - AVG(pc2) OVER ()) / stddev_pop(pc2) OVER () AS c2,
  ROW_NUMBER() OVER (ORDER BY person_id) AS i FROM sp WHERE analysis_split = 'train' AND pc1 IS NOT NULL AND pc2 IS NOT NULL),
mn AS (SELECT variant_id, ROUND(COALESCE(SUM(n_alt), 0)::DOUBLE / NULLIF((SELECT COUNT(*) FROM tp) - COUNT(*) FILTER (n_alt IS NULL), 0), 2) AS m
  FROM called SEMI JOIN tp USING (person_id) SEMI JOIN panel USING (variant_id) GROUP BY 1),
xs AS MATERIALIZED (SELECT variant_id, person_id, COALESCE(n_alt, m, 0)::DOUBLE AS x FROM called JOIN mn USING (variant_id) SEMI JOIN tp USING (person_id)),
fk AS (SELECT DISTINCT cv_fold AS k FROM tp WHERE cv_fold IS NOT NULL),
pe AS MATERIALIZED (SELECT k, i, person_id, y::DOUBLE AS y, 1.0::DOUBLE AS x0, c1 AS x1, c2 AS x2 FROM tp, fk WHERE cv_fold IS DISTINCT FROM k)
"""
        + newton_sql("nf", "pe", ["k"], 3, small=1e-9)
        + f""", sz AS (SELECT k, COUNT(*)::DOUBLE AS n, list(y ORDER BY i) AS ys FROM pe GROUP BY k),
gra AS MATERIALIZED (SELECT k, variant_id, SUM(x * (y - 1 / (1 + exp(-({eta}))))) / ANY_VALUE(sz.n) AS g FROM pe JOIN nf USING (k) JOIN sz USING (k) JOIN xs USING (person_id) GROUP BY ALL),
tops AS (SELECT k, MAX(abs(g)) AS top FROM gra GROUP BY k),
cd AS (SELECT k, variant_id, ROW_NUMBER() OVER (PARTITION BY k ORDER BY variant_id) + 3 AS j FROM gra JOIN tops USING (k) WHERE abs(g) >= 0.75 * top),
cells AS (SELECT k, 1 AS j, i, x0 AS x FROM pe UNION ALL SELECT k, 2, i, x1 FROM pe UNION ALL SELECT k, 3, i, x2 FROM pe
  UNION ALL SELECT k, j, i, COALESCE(x, 0) FROM pe JOIN cd USING (k) LEFT JOIN xs ON xs.variant_id = cd.variant_id AND xs.person_id = pe.person_id),
lines AS (SELECT k, j, list(x ORDER BY i) AS x, SUM(x * x) / (4 * COUNT(*)) AS bound FROM cells GROUP BY k, j),
mx AS MATERIALIZED (SELECT k, list(x ORDER BY j) AS x, list(bound ORDER BY j) AS bound, COUNT(*) AS p FROM lines GROUP BY k),
pt(k, part, step, b, eta) USING KEY (k, part) AS (
  SELECT k, part, 0, list_transform(range(p), lambda v: 0.0::DOUBLE), list_transform(ys, lambda v: 0.0::DOUBLE) FROM mx JOIN sz USING (k), (VALUES {", ".join(f"({f}::DOUBLE)" for f in PATH_FRACTIONS)}) t(part)
  UNION ALL
  SELECT k, part, step + 1, list_transform(b, lambda v, q: CASE WHEN q = j THEN nw ELSE v END), list_transform(list_zip(eta, col), lambda z: z[1] + (nw - old) * z[2]) FROM (
    SELECT *, CASE WHEN j <= 3 THEN u ELSE sign(u) * GREATEST(abs(u) - part * top / bd, 0) / (1 + part * top / {PATH_ALPHA} * {1 - PATH_ALPHA} / bd) END AS nw FROM (
      SELECT *, old + list_sum(list_transform(list_zip(ys, eta, col), lambda z: (z[1] - 1 / (1 + exp(-z[2]))) * z[3])) / n / bd AS u FROM (
        SELECT pt.*, ys, n, top, step % p + 1 AS j, mx.x[step % p + 1] AS col, mx.bound[step % p + 1] AS bd, b[step % p + 1] AS old FROM pt JOIN mx USING (k) JOIN sz USING (k) JOIN tops USING (k) WHERE step < 250 * p)))),
nm AS (SELECT k, j, variant_id FROM cd UNION ALL SELECT k, UNNEST([1, 2, 3]), UNNEST(['(intercept)', 'pc1', 'pc2']) FROM fk)
SELECT k::BIGINT AS fold, part, variant_id AS name, ROUND(b[j], 4) + 0.0 AS weight FROM pt JOIN nm USING (k) WHERE j <= 3 OR abs(b[j]) > 1e-7
"""
    )


@query("sparse_model_path", _path_sql(), decimals=4)
def sparse_path(lens: Lens) -> DataFrame:
    """The first steps of every held-out fold's path, with what the strong rule and the optimality check let in."""
    rows, calls = _sparse_inputs(lens)
    path = sparse_model.fit_path(calls, rows, ["pc1", "pc2"], [PATH_ALPHA], lambdas=PATH_FRACTIONS)
    out = []
    for fit in path.fits:
        for part, (_, dense, weights) in zip(PATH_FRACTIONS, fit.path):
            named = list(zip(["(intercept)", "pc1", "pc2"], dense.tolist())) + list(weights.items())
            out += [(int(fit.fold), part, name, w) for name, w in named]
    return lens.spark.createDataFrame(out, "fold bigint, part double, name string, weight double")


def _sparse_inputs(lens: Lens) -> tuple[DataFrame, DataFrame]:
    """People, and the calls of the variants that pass on train people alone."""
    rows = cut_lineage(clinical_input(lens))
    train = rows.filter("analysis_split = 'train'").withColumnRenamed("analysis_case", "outcome")
    panel = flagged(lens, train).filter("biallelic and qc_pass").select("variant_id")
    return rows, cut_lineage(called(lens).join(panel, "variant_id", "left_semi"))


@query("sparse_genotype_model")
def sparse_genotypes(lens: Lens) -> DataFrame:
    """Metric rows of the model that the whole path, cross-validation and averaging choose."""
    rows, calls = _sparse_inputs(lens)
    path = sparse_model.fit_path(calls, rows, ["pc1", "pc2"], [0.5], steps=12, ratio=0.15, patience=2)
    predicted = sparse_model.scored(path, sparse_model.chosen_model(path))
    return metrics.evaluation_rows(predicted.withColumnRenamed("analysis_split", "evaluation_set"), ["evaluation_set"])


EVALUATED_SQL = CLINICAL_SQL + ", ev AS (SELECT person_id, analysis_split, y, CAST(observation_days AS DOUBLE) AS score FROM cl)\n"


@query(
    "evaluation_set_metrics",
    EVALUATED_SQL + _auc_sql("ev", "analysis_split")
    + """, ms AS (SELECT analysis_split AS grp, AVG(score) FILTER (WHERE y = 1) AS mc, AVG(score) FILTER (WHERE y = 0) AS mk, stddev_samp(score) FILTER (WHERE y = 1) AS sc,
  stddev_samp(score) FILTER (WHERE y = 0) AS sk FROM ev GROUP BY 1)
SELECT grp AS evaluation_set, n, cases, controls, ROUND(cases / n::DOUBLE, 5) AS prevalence, ROUND(roc_auc, 5) AS roc_auc, ROUND(average_precision, 5) AS average_precision,
  ROUND(mc, 5) AS mean_score_case, ROUND(mk, 5) AS mean_score_control, ROUND(sc, 5) AS sd_score_case, ROUND(sk, 5) AS sd_score_control FROM dis JOIN ms USING (grp)""",
    decimals=5,
)
def evaluation_sets(lens: Lens) -> DataFrame:
    rows = clinical_input(lens).select("person_id", F.col("analysis_split").alias("evaluation_set"), F.col("analysis_case").cast("int").alias("y"), F.col("observation_days").cast("double").alias("score"))
    return metrics.evaluation_rows(rows, ["evaluation_set"])


_COMPARED = "n, cases, controls, roc_auc, average_precision, brier_score, log_loss, sensitivity, specificity, ppv, npv"


@query(
    "model_comparison",
    CLINICAL_SQL + _FULL + metrics_sql("mm", "m_p", "analysis_split", "(SELECT cut FROM m_t)")
    + ", sy AS (SELECT person_id, y, CAST(observation_days AS DOUBLE) AS score FROM cl WHERE analysis_split = 'test')"
    + _auc_sql("sy", "1").replace("PARTITION BY 1 ", "")
    + f""", cm AS (SELECT grp, {METRIC_ROW} FROM mm)
SELECT 'Clinical only' AS model, {_COMPARED} FROM cm WHERE grp = 'test'
UNION ALL SELECT 'Score only', n, cases, controls, ROUND(roc_auc, 4), ROUND(average_precision, 4), NULL, NULL, NULL, NULL, NULL, NULL FROM dis""",
    decimals=4,
)
def compared_models(lens: Lens) -> DataFrame:
    """The clinical model's test row beside a score's, which has no probabilities."""
    rows = cut_lineage(clinical_input(lens))
    clinical = models.run_model(rows, "analysis_case", CLINICAL)["metrics"]
    score = rows.filter("analysis_split = 'test'").select("person_id", F.col("analysis_case").cast("int").alias("y"), F.col("observation_days").cast("double").alias("score"))
    return metrics.model_comparison({"Clinical only": clinical, "Score only": metrics.discrimination(score)})
