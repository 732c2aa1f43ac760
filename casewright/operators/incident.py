"""Incident (time-at-risk) cohort, one row per person, from two event scans.

Each event table is reduced to one row per (person, day) and then to one sorted array of days per person.
The array is bounded by the days of a lifetime however many records a person has, so the rest of the
phenotype (baseline, horizon, nearest lab, exclusions, history) is row-local work after two joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from casewright.functions.scalars import age_at, lenient_double
from casewright.operators.cohort import _is_icd, baseline_frame, observation_windows, record_source
from casewright.operators.describe import long_counts
from casewright.operators.predicates import any_rule_matches, rule_matches
from casewright.rules import Concepts, IncidentRules
from casewright.session import cut_lineage


def _bit(i: int) -> Column:
    return F.lit(1 << i)


def condition_days(conditions: DataFrame, groups: Sequence[Sequence[Concepts]]) -> DataFrame:
    """person_id, cond_days: sorted array of (d, den, m); bit i of m says group i matched that day."""
    source = record_source(conditions)
    mask = reduce(
        lambda a, b: a.bitwiseOR(b),
        [F.when(any_rule_matches(rules), _bit(i)).otherwise(F.lit(0)) for i, rules in enumerate(groups)],
    )
    daily = (
        conditions.filter(F.col("event_date").isNotNull())
        .groupBy("person_id", F.col("event_date").alias("d"))
        .agg(
            F.bool_or(_is_icd() if source.startswith("icd") else F.lit(True)).alias("den"),
            F.bit_or(mask).alias("m"),
        )
    )
    return daily.groupBy("person_id").agg(
        F.sort_array(F.collect_list(F.struct("d", "den", "m"))).alias("cond_days"),
        F.first(F.lit(source)).alias("condition_record_source"),
    )


def lab_days(measurements: DataFrame, confirming: Concepts, labs: Sequence[Concepts]) -> DataFrame:
    """person_id, lab_days: sorted array of (d, ck, ck_max, v0, n0, v1, n1, …), one entry per day."""
    value = lenient_double("value")
    is_ck = rule_matches(confirming)
    per_lab = []
    for i, lab in enumerate(labs):
        hit = F.when(rule_matches(lab), value)
        per_lab += [F.max(hit).alias(f"v{i}"), F.count(hit).alias(f"n{i}")]
    daily = (
        measurements.filter(F.col("event_date").isNotNull())
        .groupBy("person_id", F.col("event_date").alias("d"))
        .agg(F.bool_or(is_ck).alias("ck"), F.max(F.when(is_ck, value)).alias("ck_max"), *per_lab)
    )
    fields = [c for c in daily.columns if c != "person_id"]
    return daily.groupBy("person_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("lab_days"))


def _dates(array: Column, keep) -> Column:
    return F.transform(F.filter(array, keep), lambda x: x["d"])


def _any(array: Column, test) -> Column:
    return F.coalesce(F.exists(array, test), F.lit(False))


def _has(x: Column, i: int) -> Column:
    return x["m"].bitwiseAND(_bit(i)) != 0


def _lab_history(labs: Column, baseline: Column, i: int, prefix: str) -> dict[str, Column]:
    """Last, highest and number of readings strictly before baseline; NULL when there are none."""
    before = F.filter(labs, lambda x: (x["d"] < baseline) & x[f"v{i}"].isNotNull())
    n = F.aggregate(before, F.lit(0).cast("long"), lambda acc, x: acc + x[f"n{i}"])
    return {
        f"{prefix}_last": F.get(F.reverse(before), F.lit(0))[f"v{i}"],
        f"{prefix}_max": F.array_max(F.transform(before, lambda x: x[f"v{i}"])),
        f"{prefix}_n": F.when(n > 0, n),
    }


def baseline_dates(frame: DataFrame, rules: IncidentRules) -> DataFrame:
    """Washout end, second distinct record date, first activity on or after both, horizon and eligibility."""
    den = _dates(F.col("cond_days"), lambda x: x["den"])
    frame = frame.withColumns(
        {
            "washout_end_date": F.date_add("obs_start_date", rules.lookback_days),
            "_den": den,
        }
    ).withColumns(
        {
            "condition_dates": F.coalesce(F.when(F.col("_den").isNotNull(), F.size("_den")), F.lit(0)),
            "second_condition_date": F.get("_den", F.lit(1)),
            "last_condition_date": F.array_max("_den"),
            "last_measurement_date": F.array_max(F.transform("lab_days", lambda x: x["d"])),
        }
    )
    floor = F.when(
        F.col("second_condition_date").isNotNull() & F.col("washout_end_date").isNotNull(),
        F.greatest("second_condition_date", "washout_end_date"),
    )
    frame = frame.withColumn("_floor", floor)
    first = F.least(
        F.array_min(F.filter("_den", lambda d: d >= F.col("_floor"))),
        F.array_min(_dates(F.col("lab_days"), lambda x: x["d"] >= F.col("_floor"))),
    )
    frame = frame.withColumn("baseline_date", first)
    return frame.withColumns(
        {
            "horizon_start_date": F.date_add("baseline_date", 1),
            "horizon_end_date": F.date_add("baseline_date", rules.horizon_days),
            "eligible_denominator": F.coalesce(
                F.col("baseline_date").isNotNull()
                & F.col("obs_end_date").isNotNull()
                & (F.col("condition_dates") >= 2)
                & (F.col("washout_end_date") <= F.col("baseline_date")),
                F.lit(False),
            ),
        }
    ).drop("_den", "_floor")


def build_incident_cohort(
    person: DataFrame,
    periods: DataFrame,
    conditions: DataFrame,
    measurements: DataFrame,
    rules: IncidentRules,
    ancestry: DataFrame | None = None,
) -> DataFrame:
    history = list(rules.history.items())
    groups = [(rules.target,), rules.trauma, rules.sepsis, rules.supportive, *[r for _, r in history]]
    base = baseline_frame(person, observation_windows(periods))
    if ancestry is not None:
        base = base.join(ancestry, "person_id", "left")
    frame = base.join(condition_days(conditions, groups), "person_id", "left").join(
        lab_days(measurements, rules.lab, rules.labs), "person_id", "left"
    )
    frame = baseline_dates(frame, rules)
    cond, labs = F.col("cond_days"), F.col("lab_days")
    base_d, hs, he = F.col("baseline_date"), F.col("horizon_start_date"), F.col("horizon_end_date")
    high = lambda x: F.coalesce(x["ck_max"] >= rules.lab_min, F.lit(False))
    in_horizon = lambda x: (x["d"] >= hs) & (x["d"] <= he)

    flags: dict[str, Column] = {
        "age_at_baseline": age_at(base_d, F.col("year_of_birth"), F.col("birth_date"), F.col("age_raw")),
        "first_target_ever_date": F.array_min(_dates(cond, lambda x: _has(x, 0))),
        "prior_target_date": F.array_min(_dates(cond, lambda x: _has(x, 0) & (x["d"] < base_d))),
        "first_target_date": F.array_min(
            _dates(cond, lambda x: _has(x, 0) & (x["d"] > base_d) & (x["d"] <= he))
        ),
        "prior_high_ck": _any(labs, lambda x: high(x) & (x["d"] < base_d)).cast("int"),
        "high_ck_during_horizon": _any(labs, lambda x: high(x) & in_horizon(x)).cast("int"),
        "ck_tested_during_horizon": _any(labs, lambda x: x["ck"] & in_horizon(x)).cast("int"),
        "ck_tested_prebaseline": _any(labs, lambda x: x["ck"] & (x["d"] < base_d)).cast("int"),
    }

    def history_flag(i: int) -> Column:
        return _any(cond, lambda x: _has(x, i) & (x["d"] < base_d)).cast("int")

    for i, (name, _) in enumerate(history, start=4):
        flags[name] = history_flag(i)
    for i, lab in enumerate(rules.labs):
        flags |= _lab_history(labs, base_d, i, f"prebaseline_{lab.label}")
    frame = frame.withColumns(flags)

    index = F.col("first_target_date")

    def near_index(i: int, window: tuple[int, int]) -> Column:
        return _any(cond, lambda x: _has(x, i) & F.datediff(x["d"], index).between(*window)).cast("int")

    confirming = F.array_min(
        F.transform(
            F.filter(labs, lambda x: high(x) & F.datediff(x["d"], index).between(*rules.lab_window)),
            lambda x: F.struct(
                F.abs(F.datediff(x["d"], index)).alias("distance"), x["d"].alias("d"), x["ck_max"].alias("v")
            ),
        )
    )
    frame = frame.withColumns(
        {
            "_confirm": confirming,
            "target_during_horizon": index.isNotNull().cast("int"),
            "excluded_periindex_trauma": near_index(1, rules.trauma_window),
            "excluded_pre_or_same_day_sepsis": near_index(2, rules.sepsis_window),
            "supportive_code": near_index(3, rules.supportive_window),
            "last_clinical_activity_date": F.greatest("last_condition_date", "last_measurement_date"),
            "incident_denominator": (
                F.col("eligible_denominator") & F.col("prior_target_date").isNull() & (F.col("prior_high_ck") == 0)
            ).cast("int"),
        }
    ).withColumns(
        {
            "ck_confirming_date": F.col("_confirm.d"),
            "ck_confirming_value": F.col("_confirm.v"),
            "ck_confirmed_index": F.col("_confirm").isNotNull().cast("int"),
        }
    )
    return _outcomes(frame.drop("_confirm", "cond_days", "lab_days"))


def _flag(test: Column) -> Column:
    return F.coalesce(test, F.lit(False)).cast("int")


def _outcomes(frame: DataFrame) -> DataFrame:
    is1 = lambda c: F.col(c) == 1
    incident_case = is1("incident_denominator") & F.col("first_target_date").isNotNull()
    active = F.col("last_clinical_activity_date")
    frame = frame.withColumns(
        {
            "diagnosis_only_case": _flag(
                incident_case
                & (F.col("excluded_periindex_trauma") == 0)
                & (F.col("excluded_pre_or_same_day_sepsis") == 0)
            ),
            "ck_only_no_target": _flag(
                is1("incident_denominator") & (F.col("target_during_horizon") == 0) & is1("high_ck_during_horizon")
            ),
            "observed_followup_through_horizon": _flag(
                (F.col("obs_end_date") >= F.col("horizon_end_date"))
                & (active.isNull() | (active >= F.col("baseline_date")))
            ),
        }
    )
    frame = frame.withColumns(
        {
            "primary_case": _flag(is1("diagnosis_only_case") & is1("ck_confirmed_index")),
            "eligible_control": _flag(
                is1("incident_denominator")
                & is1("observed_followup_through_horizon")
                & (F.col("target_during_horizon") == 0)
                & (F.col("high_ck_during_horizon") == 0)
            ),
        }
    )
    return frame.withColumns(
        {
            "supportive_coded_case": _flag(is1("primary_case") & is1("supportive_code")),
            "ck_tested_control": _flag(is1("eligible_control") & is1("ck_tested_during_horizon")),
            "analysis_case": F.col("primary_case"),
            "case_control_eligible": _flag(is1("primary_case") | is1("eligible_control")),
            "case_tier": F.when(is1("primary_case"), "incident_primary")
            .when(is1("diagnosis_only_case"), "diagnosis_only")
            .when(is1("ck_only_no_target"), "ck_only_no_target")
            .when(is1("eligible_control"), "control")
            .otherwise("excluded_or_unclassified"),
        }
    )


def case_control_rows(built: DataFrame, *columns: str) -> DataFrame:
    """The eligible rows of a built cohort, all columns or the given ones, read from a written table.

    Written before the filter: a filter on the outcome would move below the columns that make it up, and work the baseline
    date out once more for every day of every person.
    """
    flag = "case_control_eligible"
    stored = cut_lineage(built.select(*columns, flag) if columns else built)
    kept = stored.filter(F.coalesce(F.col(flag).cast("int"), F.lit(0)) == 1)
    return kept.select(*columns) if columns else kept


def incident_consort(cohort: DataFrame) -> DataFrame:
    """17-step flow counts in one pass."""
    total = lambda c: F.sum(F.col(c).cast("long"))
    return long_counts(
        cohort,
        {
            "source_rows": F.count(F.lit(1)),
            "observation_rows": F.count("obs_start_date"),
            "eligible_denominator": total("eligible_denominator"),
            "excluded_prior_target": F.count("prior_target_date"),
            "excluded_prior_high_ck": total("prior_high_ck"),
            "incident_denominator": total("incident_denominator"),
            "target_in_horizon": total("target_during_horizon"),
            "target_with_confirming_lab": total("ck_confirmed_index"),
            "excluded_trauma": total("excluded_periindex_trauma"),
            "excluded_sepsis": total("excluded_pre_or_same_day_sepsis"),
            "primary_cases": total("primary_case"),
            "diagnosis_only_cases": total("diagnosis_only_case"),
            "supportive_coded_cases": total("supportive_coded_case"),
            "ck_only_no_target": total("ck_only_no_target"),
            "eligible_controls": total("eligible_control"),
            "ck_tested_controls": total("ck_tested_control"),
            "model_eligible_rows": total("case_control_eligible"),
        },
        name="step",
    )


def feasibility_flags(cohort: DataFrame) -> DataFrame:
    """Per-person feasibility: trauma excludes, sepsis only flags."""
    is1 = lambda c: F.col(c) == 1
    case = is1("incident_denominator") & F.col("first_target_date").isNotNull()
    return cohort.withColumns(
        {
            "incident_case": _flag(case),
            "nontrauma_case": _flag(case & (F.col("excluded_periindex_trauma") == 0)),
        }
    ).withColumns(
        {
            "ck_confirmed_nontrauma_case": _flag(is1("nontrauma_case") & is1("ck_confirmed_index")),
            "supportive_nontrauma_case": _flag(is1("nontrauma_case") & is1("supportive_code")),
            "sepsis_flagged_nontrauma_case": _flag(is1("nontrauma_case") & is1("excluded_pre_or_same_day_sepsis")),
        }
    )


def feasibility_ids(cohort: DataFrame) -> DataFrame:
    return (
        feasibility_flags(cohort)
        .filter((F.col("nontrauma_case") == 1) | (F.col("eligible_control") == 1))
        .select(
            "person_id",
            "nontrauma_case",
            "ck_confirmed_nontrauma_case",
            "supportive_nontrauma_case",
            "sepsis_flagged_nontrauma_case",
            "eligible_control",
            "ck_tested_control",
        )
    )


# History bins as (label, low, high) days from observation start to the first event.
HISTORY_BINS = (
    ("<365d before first event", None, 364),
    ("365-729d before first event", 365, 729),
    ("730-1094d before first event", 730, 1094),
    (">=1095d before first event", 1095, None),
)


def feasibility_summary(cohort: DataFrame) -> DataFrame:
    """(section, metric, n): case funnel, control funnel, counts and history bins from one pass."""
    f = feasibility_flags(cohort)
    is1 = lambda c: F.col(c) == 1
    dated = F.col("first_target_date").isNotNull()
    denominator = is1("incident_denominator")
    no_target = denominator & (F.col("target_during_horizon") == 0)
    history = F.datediff("first_target_ever_date", "obs_start_date")
    nontrauma = is1("nontrauma_case")
    tests: list[tuple[str, str, Column]] = [
        ("case_funnel", "All participants", F.lit(True)),
        ("case_funnel", "Any target ever", F.col("first_target_ever_date").isNotNull()),
        ("case_funnel", "First target within horizon", dated),
        ("case_funnel", "With baseline history", dated & F.col("eligible_denominator")),
        ("case_funnel", "No prior target or high lab", is1("incident_case")),
        ("case_funnel", "Non-trauma incident cases", nontrauma),
        ("case_funnel", "Lab-confirmed non-trauma cases", is1("ck_confirmed_nontrauma_case")),
        ("case_funnel", "Supportive-coded non-trauma cases", is1("supportive_nontrauma_case")),
        ("case_funnel", "Sepsis-flagged non-trauma cases", is1("sepsis_flagged_nontrauma_case")),
        ("control_funnel", "Incident denominator", denominator),
        ("control_funnel", "No target during horizon", no_target),
        ("control_funnel", "No target or high lab during horizon", no_target & (F.col("high_ck_during_horizon") == 0)),
        ("control_funnel", "Observed through horizon", denominator & is1("observed_followup_through_horizon")),
        ("control_funnel", "Eligible controls", is1("eligible_control")),
        ("control_funnel", "Lab-tested eligible controls", is1("ck_tested_control")),
        ("feasibility_counts", "Non-trauma incident cases", nontrauma),
        ("feasibility_counts", "Lab-confirmed non-trauma cases", is1("ck_confirmed_nontrauma_case")),
        ("feasibility_counts", "Eligible controls", is1("eligible_control")),
        ("feasibility_counts", "Case-control rows", nontrauma | is1("eligible_control")),
    ]
    for label, low, high in HISTORY_BINS:
        inside = history.isNotNull()
        if low is not None:
            inside = inside & (history >= low)
        if high is not None:
            inside = inside & (history <= high)
        tests.append(("baseline_history_bins", label, inside))
    wide = f.agg(*[F.count_if(F.coalesce(t, F.lit(False))).alias(f"_{i}") for i, (_, _, t) in enumerate(tests)])
    pairs = F.array(
        *[
            F.struct(F.lit(s).alias("section"), F.lit(m).alias("metric"), F.col(f"_{i}").alias("n"))
            for i, (s, m, _) in enumerate(tests)
        ]
    )
    return wide.select(F.inline(pairs))


def genotyped_overlap(flags: DataFrame, sample_ids: DataFrame) -> DataFrame:
    """Counts of feasibility rows whose person is in the genotype sample file."""
    ids = sample_ids.select(F.col("IID").alias("person_id")).filter("person_id is not null").distinct()
    marked = ids.withColumn("_in", F.lit(1)).join(flags.withColumn("_queried", F.lit(1)), "person_id", "full")
    both = F.col("_in").isNotNull() & F.col("_queried").isNotNull()
    return long_counts(
        marked,
        {
            "genotype_sample_ids": F.count("_in"),
            "ids_queried": F.count("_queried"),
            "nontrauma_cases": F.sum("nontrauma_case"),
            **{
                f"{c}_genotyped": F.sum(F.when(both, F.col(c)).otherwise(F.lit(0)))
                for c in (
                    "nontrauma_case",
                    "ck_confirmed_nontrauma_case",
                    "supportive_nontrauma_case",
                    "sepsis_flagged_nontrauma_case",
                    "eligible_control",
                    "ck_tested_control",
                )
            },
        },
    )
