"""Tiered case-control cohort: one row per person from person, observation, condition and lab tables.

Event tables are reduced to per-person rollups before any join. Each rollup is a partial (map-side)
aggregate, so one person holding a large share of the rows never gathers in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casewright.functions.scalars import (
    age_at,
    lenient_date,
    lenient_double,
    sex_category,
    sex_flag,
    vector_elements,
)
from casewright.operators.anchors import anchored_flags
from casewright.operators.predicates import rule_matches, value_at_least, within_days
from casewright.rules import PhenotypeRules, Tier


def observation_windows(periods: DataFrame) -> DataFrame:
    return periods.groupBy("person_id").agg(
        F.min("period_start_date").alias("obs_start_date"),
        F.max("period_end_date").alias("obs_end_date"),
    )


def baseline_frame(person: DataFrame, windows: DataFrame) -> DataFrame:
    """Person ⟕ observation window with cleaned demographics; absent optional columns become NULL."""
    optional = {
        "baseline_index_date": "date",
        "birth_date": "date",
        "year_of_birth": "double",
        "age_raw": "double",
        "sex": "string",
    }
    p = person.withColumns({c: F.lit(None).cast(t) for c, t in optional.items() if c not in person.columns})
    p = p.select(
        F.col("person_id").cast("string").alias("person_id"),
        lenient_date("baseline_index_date").alias("baseline_index_date"),
        lenient_date("birth_date").alias("birth_date"),
        lenient_double("year_of_birth").alias("year_of_birth"),
        lenient_double("age_raw").alias("age_raw"),
        F.col("sex").alias("sex_source"),
        sex_category("sex").alias("sex_category"),
        sex_flag("sex").alias("is_female"),
    )
    return p.join(windows, "person_id", "left")


def ancestry_frame(raw: DataFrame, id_col: str, label_col: str, pc_cols: list[str], vector_col: str | None = None) -> DataFrame:
    """Ancestry label with pc1..pcN from separate columns, or parsed from one vector cell."""
    if all(c in raw.columns for c in pc_cols):
        pcs = [lenient_double(c) for c in pc_cols]
    elif vector_col and vector_col in raw.columns:
        pcs = vector_elements(vector_col, len(pc_cols))
    else:
        pcs = [F.lit(None).cast("double") for _ in pc_cols]
    return raw.select(
        F.col(id_col).cast("string").alias("person_id"),
        F.col(label_col).cast("string").alias("ancestry_pred"),
        *[pc.alias(f"pc{i}") for i, pc in enumerate(pcs, start=1)],
    )


def _is_icd() -> Column:
    return F.coalesce(F.upper(F.col("source_vocabulary")).startswith("ICD"), F.lit(False))


def record_source(conditions: DataFrame) -> str:
    """``icd_…`` if any dated record has an ICD source vocabulary. Stops at the first hit."""
    if "source_vocabulary" not in conditions.columns:
        return "all_condition_records"
    any_icd = not conditions.filter(F.col("event_date").isNotNull() & _is_icd()).limit(1).isEmpty()
    return "icd_source_condition_records" if any_icd else "all_condition_records"


def denominator_records(conditions: DataFrame, source: str) -> DataFrame:
    dated = conditions.filter(F.col("event_date").isNotNull())
    return dated.filter(_is_icd()) if source.startswith("icd") else dated


def denominator_counts(conditions: DataFrame) -> DataFrame:
    """Distinct condition dates per person; two or more make the person eligible."""
    source = record_source(conditions)
    return (
        denominator_records(conditions, source)
        .groupBy("person_id")
        .agg(F.count_distinct("event_date").alias("condition_dates"))
        .select(
            "person_id",
            "condition_dates",
            F.lit(source).alias("condition_record_source"),
            (F.col("condition_dates") >= 2).alias("eligible_denominator"),
        )
    )


def measurement_days(measurements: DataFrame, rule: Tier) -> DataFrame:
    """Rule-matching lab readings, one row per (person, day) with the day's highest value."""
    match = rule_matches(rule.reading.concepts)
    return (
        measurements.filter(match & value_at_least(F.col("value"), rule.reading.least))
        .groupBy("person_id", "event_date")
        .agg(F.max(lenient_double("value")).alias("value"))
    )


def _condition_first(conditions: DataFrame, rule: Tier) -> DataFrame:
    return (
        conditions.filter(rule_matches(rule.conditions))
        .groupBy("person_id")
        .agg(F.min("event_date").alias("condition_date"))
    )


def tier_hits(conditions: DataFrame, measurements: DataFrame, rule: Tier) -> DataFrame:
    """(person_id, condition_date, measurement_date, measurement_value) for one rule.

    Both required: the anchor is the first condition date, the lab date and value are MIN and MAX
    inside the directional window. Neither required: both sides are kept by a full outer join.
    """
    no_date, no_value = F.lit(None).cast("date"), F.lit(None).cast("double")
    if rule.evidence.condition and not rule.evidence.lab:
        return _condition_first(conditions, rule).select(
            "person_id", "condition_date", no_date.alias("measurement_date"), no_value.alias("measurement_value")
        )
    days = measurement_days(measurements, rule)
    summary = [F.min("event_date").alias("measurement_date"), F.max("value").alias("measurement_value")]
    if not rule.evidence.condition:
        lab = days.groupBy("person_id").agg(*summary)
        if rule.evidence.lab:
            return lab.select("person_id", no_date.alias("condition_date"), "measurement_date", "measurement_value")
        return _condition_first(conditions, rule).join(lab, "person_id", "full").select(
            "person_id", "condition_date", "measurement_date", "measurement_value"
        )
    return (
        _condition_first(conditions, rule)
        .join(days, "person_id")
        .filter(within_days(F.col("event_date"), F.col("condition_date"), rule.window.first, rule.window.last))
        .groupBy("person_id", "condition_date")
        .agg(*summary)
    )


def _hit_columns(rule: Tier, prefix: str) -> dict[str, Column]:
    cond, meas = F.col(f"{prefix}_condition_date"), F.col(f"{prefix}_measurement_date")
    hit = F.lit(True)
    if rule.evidence.condition:
        hit = hit & cond.isNotNull()
    if rule.evidence.lab:
        hit = hit & meas.isNotNull()
    if not rule.evidence.condition and not rule.evidence.lab:
        hit = cond.isNotNull() | meas.isNotNull()
    return {
        f"{prefix}_has_condition": cond.isNotNull(),
        f"{prefix}_has_measurement": meas.isNotNull(),
        f"{prefix}_rule_hit": hit,
        f"{prefix}_index_date": F.coalesce(cond, meas),
    }


def attach_hits(base: DataFrame, hits: DataFrame, rule: Tier, prefix: str) -> DataFrame:
    renamed = hits.select("person_id", *[F.col(c).alias(f"{prefix}_{c}") for c in hits.columns if c != "person_id"])
    return base.join(renamed, "person_id", "left").withColumns(_hit_columns(rule, prefix))


def cofactor_events(conditions: DataFrame, rules: PhenotypeRules) -> DataFrame:
    """Distinct (person, cofactor, date), all rules in one scan."""
    tags = F.array_compact(F.array(*[F.when(rule_matches(r), F.lit(r.label)) for r in rules.cofactors]))
    return (
        conditions.filter(F.col("event_date").isNotNull())
        .select("person_id", F.explode(tags).alias("cofactor"), "event_date")
        .dropDuplicates()
    )


def cofactor_ever(events: DataFrame, rules: PhenotypeRules) -> DataFrame:
    """Wide 0/1 flags per person."""
    return events.groupBy("person_id").agg(
        *[F.max((F.col("cofactor") == n).cast("int")).alias(n) for n in rules.cofactor_names]
    )


def merge_ever_flags(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Full outer join of two flag tables, OR-ing each flag."""
    r = right.select("person_id", *[F.col(n).alias(f"_r_{n}") for n in names if n in right.columns])
    joined = left.join(r, "person_id", "full")

    def side(column: str) -> Column:
        return F.coalesce(F.col(column).try_cast("double"), F.lit(0.0)) if column in joined.columns else F.lit(0.0)

    return joined.withColumns(
        {n: (F.greatest(side(n), side(f"_r_{n}")) >= 1).cast("int") for n in names}
    ).drop(*[f"_r_{n}" for n in names])


def finalize_tiers(df: DataFrame, rules: PhenotypeRules) -> DataFrame:
    dates = F.coalesce(F.col("condition_dates"), F.lit(0))
    eligible = dates >= 2
    df = df.withColumns(
        {
            "condition_dates": dates,
            "eligible_denominator": eligible,
            "broad_rule_hit": F.col("broad_rule_hit") & eligible,
        }
    ).withColumns(
        {
            "definite_rule_hit": F.col("definite_rule_hit") & F.col("broad_rule_hit"),
            "high_measurement": F.col("high_measurement_date").isNotNull(),
        }
    )
    tier = (
        F.when(~F.col("eligible_denominator"), "excluded_denominator")
        .when(F.col("definite_rule_hit"), "definite")
        .when(F.col("broad_rule_hit"), "broad")
        .when(F.col("high_measurement"), "indeterminate_ck_only")
        .otherwise("control")
    )
    index = F.coalesce("broad_index_date", "definite_index_date", "baseline_index_date")
    return (
        df.withColumns(
            {
                "case_tier": tier,
                "broad_case": F.col("broad_rule_hit").cast("int"),
                "definite_case": F.col("definite_rule_hit").cast("int"),
                "index_date": index,
                "observation_days": F.datediff("obs_end_date", "obs_start_date"),
            }
        )
        .withColumns(
            {
                "age_at_index": age_at(
                    F.col("index_date"), F.col("year_of_birth"), F.col("birth_date"), F.col("age_raw")
                ),
                "eligible_control": (F.col("case_tier") == "control")
                & ~F.col("control_excluded")
                & (F.coalesce(F.col("observation_days"), F.lit(-1)) >= rules.observed_days),
            }
        )
    )


def condition_rollup(conditions: DataFrame, rules: PhenotypeRules) -> DataFrame:
    """Everything the cohort needs from conditions, in one scan and one row per person.

    Records are first reduced to (person, day) with a rule bit mask, so the per-person step sees at most the
    days of a lifetime however many records a person has.
    """
    source = record_source(conditions)
    tests = {
        "broad": rule_matches(rules.broad.conditions),
        "definite": rule_matches(rules.definite.conditions),
        "excluded": rule_matches(rules.no_controls),
        **{r.label: rule_matches(r) for r in rules.cofactors},
    }
    if len(tests) > 62:
        raise ValueError("at most 59 cofactors fit the day mask")
    bit = {name: 1 << i for i, name in enumerate(tests)}
    mask = F.lit(0)
    for name, test in tests.items():
        mask = mask.bitwiseOR(F.when(test, F.lit(bit[name])).otherwise(F.lit(0)))
    counted = F.col("event_date").isNotNull()
    if source.startswith("icd"):
        counted = counted & _is_icd()
    daily = conditions.groupBy("person_id", F.col("event_date").alias("_d")).agg(
        F.bool_or(counted).alias("_den"), F.bit_or(mask).alias("_m")
    )
    on_day = lambda name: F.when(F.col("_m").bitwiseAND(F.lit(bit[name])) != 0, F.col("_d"))
    return daily.groupBy("person_id").agg(
        F.count_if("_den").alias("condition_dates"),
        F.lit(source).alias("condition_record_source"),
        F.min(on_day("broad")).alias("_first_broad"),
        F.min(on_day("definite")).alias("_first_definite"),
        F.bool_or(F.col("_m").bitwiseAND(F.lit(bit["excluded"])) != 0).alias("control_excluded"),
        *[F.sort_array(F.collect_list(on_day(n))).alias(f"_dates_{n}") for n in rules.cofactor_names],
    )


def _definite_labs(days: DataFrame, first: DataFrame, rule: Tier) -> DataFrame:
    """High readings of the definite rule, overall and inside the window of the first definite condition."""
    inside = within_days(F.col("event_date"), F.col("_first_definite"), rule.window.first, rule.window.last)
    return (
        days.join(first, "person_id", "left")
        .groupBy("person_id")
        .agg(
            F.min("event_date").alias("high_measurement_date"),
            F.max("value").alias("high_measurement_value"),
            F.min(F.when(inside, F.col("event_date"))).alias("measurement_date"),
            F.max(F.when(inside, F.col("value"))).alias("measurement_value"),
        )
    )


def build_cohort(
    person: DataFrame,
    periods: DataFrame,
    conditions: DataFrame,
    measurements: DataFrame,
    rules: PhenotypeRules,
    ancestry: DataFrame | None = None,
    clinical_flags: DataFrame | None = None,
) -> DataFrame:
    """The whole tiered cohort with time-anchored cofactor flags, one row per person."""
    names = rules.cofactor_names
    roll = condition_rollup(conditions, rules)
    labs = _definite_labs(
        measurement_days(measurements, rules.definite), roll.select("person_id", "_first_definite"), rules.definite
    )
    base = baseline_frame(person, observation_windows(periods)).join(roll, "person_id", "left")
    base = base.join(labs, "person_id", "left").withColumn(
        "control_excluded", F.coalesce("control_excluded", F.lit(False))
    )
    if ancestry is not None:
        base = base.join(ancestry, "person_id", "left")
    if clinical_flags is not None:
        base = base.join(clinical_flags, "person_id", "left")
    base = _attach_rule(base, rules.broad, "broad", conditions, measurements, roll)
    base = _attach_rule(base, rules.definite, "definite", conditions, measurements, roll)
    base = base.drop("_first_broad", "_first_definite", "measurement_date", "measurement_value")
    return anchored_flags(finalize_tiers(base, rules), None, names)


def _attach_rule(base, rule, prefix, conditions, measurements, roll) -> DataFrame:
    """Use the columns already on ``base`` where the rule allows; otherwise join the rule's own hits."""
    first = F.col(f"_first_{prefix}")
    none_d, none_v = F.lit(None).cast("date"), F.lit(None).cast("double")
    if rule.evidence.condition and not rule.evidence.lab:
        cols = (first, none_d, none_v)
    elif prefix == "definite" and rule.evidence.condition and rule.evidence.lab:
        hit = F.col("measurement_date").isNotNull()
        cols = (F.when(hit, first), F.col("measurement_date"), F.when(hit, F.col("measurement_value")))
    else:
        return attach_hits(base, tier_hits(conditions, measurements, rule), rule, prefix)
    names = ("condition_date", "measurement_date", "measurement_value")
    base = base.withColumns({f"{prefix}_{n}": c for n, c in zip(names, cols, strict=True)})
    return base.withColumns(_hit_columns(rule, prefix))


def cohort_qc(cohort: DataFrame) -> DataFrame:
    """Long (metric, n) quality-control counts in one pass."""
    metrics = {
        "n_people": F.count(F.lit(1)),
        "eligible_denominator": F.count_if("eligible_denominator"),
        "broad_cases": F.sum("broad_case"),
        "definite_cases": F.sum("definite_case"),
        "eligible_controls": F.count_if("eligible_control"),
        **{
            f"tier_{t}": F.count_if(F.col("case_tier") == t)
            for t in ("definite", "broad", "indeterminate_ck_only", "control", "excluded_denominator")
        },
    }
    from casewright.operators.describe import long_counts

    return long_counts(cohort, metrics)


def restrict_to_flagged(base: DataFrame, flags: DataFrame) -> DataFrame:
    """Keep people whose availability flag is 1; applied before any event work."""
    return base.join(flags.filter(F.col("has_wgs") == 1).select("person_id"), "person_id", "left_semi")
