import pytest
from pyspark.sql import functions as F

import fixtures as fx
from casewright.functions import scalars as S
from casewright.operators import anchors, cohort, incident, profile, splits
from casewright.plans import drivers


def build(spark, **kw):
    return {r.person_id: r for r in cohort.build_cohort(*fx.case_control(spark, **kw), fx.RULES).collect()}


def test_tiers(spark):
    rows = build(spark)
    expected = {"a": "definite", "b": "definite", "c": "definite", "d": "broad", "e": "control", "n": "indeterminate_ck_only"}
    assert {p: rows[p].case_tier for p in expected} == expected
    assert not rows["n"].eligible_control and rows["e"].eligible_control
    assert rows["a"].index_date == fx.d("2019-05-20")


def test_lab_before_window_leaves_broad(spark):
    moved = [m if m[:2] != ("b", 61) else ("b", 61, "Enzyme E", 2200, "2019-06-20") for m in fx.MEASUREMENTS]
    assert build(spark, measurements=moved)["b"].case_tier == "broad"


def test_single_condition_date_is_excluded(spark):
    one = [c for c in fx.CONDITIONS if c[:2] != ("d", 70)]
    row = build(spark, conditions=one)["d"]
    assert (row.case_tier, row.condition_dates, row.eligible_denominator) == ("excluded_denominator", 1, False)


def test_anchored_flags(spark):
    rows = build(spark)
    assert (rows["a"].periindex_sepsis, rows["a"].preindex_sepsis) == (1, 0)
    assert (rows["b"].periindex_renal_injury, rows["b"].preindex_renal_injury) == (1, 0)
    assert rows["c"].preindex_sepsis == rows["c"].remote_preindex_sepsis == 1
    assert rows["c"].preindex_renal_injury == rows["c"].remote_preindex_renal_injury == 1


def test_each_row_has_its_own_anchor(spark):
    rows = spark.createDataFrame([("5", fx.d("2022-01-10")), ("5", fx.d("2021-01-01"))], "person_id string, index_date date")
    events = spark.createDataFrame([("5", "sepsis", fx.d("2021-01-05"))], "person_id string, cofactor string, event_date date")
    got = {str(r.index_date): r for r in anchors.anchored_flags(rows, events, ["sepsis"]).collect()}
    assert got["2022-01-10"].preindex_sepsis == 1 and got["2022-01-10"].periindex_sepsis == 0
    assert got["2021-01-01"].preindex_sepsis == 0 and got["2021-01-01"].periindex_sepsis == 1


def test_sex_categories(spark):
    rows = spark.createDataFrame([("",), ("not male or female",), ("F",), (" Male ",), (None,)], "sex string")
    got = [(r.c, r.f) for r in rows.select(S.sex_category("sex").alias("c"), S.sex_flag("sex").alias("f")).collect()]
    assert got == [("missing", None), ("other_or_unknown", None), ("female", 1.0), ("male", 0.0), ("missing", None)]


def test_prior_timing(spark):
    frames = fx.case_control(spark)
    cases = cohort.build_cohort(*frames, fx.RULES).filter("broad_case = 1")
    events = cohort.cofactor_events(frames[2], fx.RULES)
    got = {(r.cofactor, r.timing_bin): r for r in anchors.prior_timing_summary(cases, events, ["sepsis", "renal_injury"]).collect()}
    assert got["renal_injury", "1_to_7_days_before"].n == 1
    assert got["sepsis", "91_to_365_days_before"].n == 1
    assert got["sepsis", "any_prior"].median_days == 162.0
    assert got["sepsis", "same_day"].n == 0 and len(got) == 14


def test_presentation_timing(spark):
    model = spark.createDataFrame(
        [("100", 1, fx.d("2021-06-30")), ("200", 0, fx.d("2021-06-30"))], "person_id string, analysis_case int, index_date date"
    )
    events = spark.createDataFrame(
        [("100", "sepsis", fx.d("2021-06-10")), ("200", "sepsis", fx.d("2021-06-30")), ("200", "renal_injury", fx.d("2021-12-01"))],
        "person_id string, cofactor string, event_date date",
    )
    got = {
        (r.group, r.cofactor, r.timing_bin): r.n
        for r in anchors.timing_histogram(model, events, ["sepsis", "renal_injury"]).collect()
    }
    assert got["cases", "sepsis", "-30 to -8"] == got["controls", "sepsis", "index day"] == 1
    assert got["controls", "renal_injury", "+91 to +365"] == 1 and sum(got.values()) == 3


def test_profile(spark):
    frames = fx.case_control(spark)
    built = cohort.build_cohort(*frames, fx.RULES)
    out = drivers.preindex_profile(built, frames[2], frames[3], "365,all")
    markers = {(r.biomarker, r.window): r for r in out["biomarkers"].collect()}
    assert markers["creatinine", "365d"].n_cases_with_measurement == 2
    assert markers["tsh", "any_prior"].n_cases_with_measurement == 0
    assert "Flare" not in {r.concept_name for r in out["top_conditions"].collect()}


def test_incident(spark):
    rows = {r.person_id: r for r in incident.build_incident_cohort(*fx.incident(spark), fx.INCIDENT).collect()}
    assert rows["t0"].primary_case == 1 and rows["t1"].supportive_coded_case == 1
    assert rows["t2"].excluded_periindex_trauma == 1 and rows["t2"].primary_case == 0
    assert rows["t3"].excluded_pre_or_same_day_sepsis == 1 and rows["t3"].primary_case == 0
    assert rows["t4"].diagnosis_only_case == 1 and rows["t4"].primary_case == 0
    assert rows["q5"].ck_only_no_target == 1 and rows["q5"].eligible_control == 0
    assert rows["t6"].incident_denominator == rows["q6"].incident_denominator == 0
    assert rows["q1"].eligible_control == 1 and rows["q7"].ck_tested_control == 1
    assert rows["q0"].baseline_date == fx.d("2018-07-02")
    assert rows["q1"].prior_kidney_disease_or_aki == 1 and rows["q3"].prior_kidney_disease_or_aki == 0
    assert rows["q2"].prior_diabetes == 1 and rows["q1"].prior_diabetes == 0
    assert rows["t1"].prebaseline_creatinine_last == pytest.approx(1.01) and rows["t1"].prebaseline_ck_n is None


def test_feasibility_keeps_sepsis_as_a_flag(spark):
    built = incident.build_incident_cohort(*fx.incident(spark), fx.INCIDENT)
    ids = {r.person_id: r for r in incident.feasibility_ids(built).collect()}
    assert ids["t3"].nontrauma_case == 1 and ids["t3"].sepsis_flagged_nontrauma_case == 1 and "t2" not in ids


def test_splits_keep_groups_together(spark):
    rows = spark.createDataFrame(
        [(f"p{i}", int(i % 2 == 0), f"g{i // 2}") for i in range(6)], "person_id string, analysis_case int, match_group_id string"
    )
    got = splits.group_splits(rows).collect()
    by_group = {}
    for r in got:
        by_group.setdefault(r.match_group_id, set()).add(r.analysis_split)
        assert (r.cv_fold is None) == (r.analysis_split == "test")
    assert all(len(s) == 1 for s in by_group.values()) and {s for v in by_group.values() for s in v} == {"train", "test"}


def test_eligibility(spark):
    schema = (
        "person_id string, analysis_case int, match_group_id string, preindex_crush_injury int, periindex_crush_injury int, "
        "periindex_sepsis int, age_at_index double, observation_days int, condition_dates int"
    )
    rows = [
        ("1", 1, "trauma", 0, 1, 0, 40.0, 900, 3), ("2", 0, "trauma", 0, 0, 0, 41.0, 900, 3),
        ("3", 1, "sepsis", 0, 0, 1, 40.0, 900, 3), ("4", 0, "sepsis", 0, 0, 0, 41.0, 900, 3),
    ]
    got = {r.person_id: r for r in splits.eligibility_flags(spark.createDataFrame(rows, schema)).collect()}
    assert got["1"].primary_model_eligible == got["2"].primary_model_eligible == 0
    assert got["3"].primary_model_eligible == got["4"].primary_model_eligible == 1
    assert got["4"].sensitivity_no_periindex_sepsis_eligible == 0
    assert all(r.sensitivity_include_trauma_eligible == 1 for r in got.values())


def test_hot_person_gives_the_same_cohort(spark):
    """One person with most of the records: repeats of a day change nothing."""
    hot = fx.CONDITIONS + [("e", 70, "Check-up", "2018-03-03")] * 500
    assert build(spark, conditions=hot) == build(spark)
