"""Leakage-safe deterministic splits, eligibility flags and their summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casewright.functions.scalars import category_or_missing, hash_hex, normalised_category
from casewright.operators.incident import case_control_rows
from casewright.operators.predicates import select_available
from casewright.operators.ranking import global_rank
from casewright.session import cut_lineage


def _test_count(n: Column, train_fraction: float) -> Column:
    """Rounded half-even share, at least 1 and at most n−1; a single group stays in train."""
    raw = F.bround(n * (1.0 - train_fraction)).cast("long")
    return F.when(n <= 1, 0).otherwise(F.least(F.greatest(F.lit(1), raw), n - 1))


def _label(ranked: DataFrame, totals: Column, folds: int, train_fraction: float) -> DataFrame:
    test = _test_count(totals, train_fraction)
    is_test = F.col("_rank") <= test
    in_train = F.col("_rank") - test - 1
    n_folds = F.least(F.lit(folds), totals - test)
    return ranked.withColumns(
        {
            "analysis_split": F.when(is_test, "test").otherwise("train"),
            "cv_fold": F.when(~is_test & (n_folds > 0), in_train % n_folds + 1).cast("int"),
        }
    )


def group_splits(matched: DataFrame, train_fraction: float = 0.8, folds: int = 5) -> DataFrame:
    """Whole match groups go to test (first in hash order) or to round-robin folds; a group is never divided."""
    key = F.coalesce("match_group_id", "person_id") if "match_group_id" in matched.columns else F.col("person_id")
    keyed = matched.withColumn("_split_group", key.cast("string"))
    groups = keyed.select("_split_group").distinct().withColumn("_hash", hash_hex("_split_group"))
    totals = groups.agg(F.count(F.lit(1)).alias("_total"))
    ranked = global_rank(groups, [F.col("_hash"), F.col("_split_group")], "_rank").crossJoin(
        F.broadcast(totals)  # one row
    )
    labels = _label(ranked, F.col("_total"), folds, train_fraction).select("_split_group", "analysis_split", "cv_fold")
    return keyed.join(labels, "_split_group").drop("_split_group")


def incident_model_input(built: DataFrame) -> DataFrame:
    """Eligible rows of an incident cohort with splits and the model's categories, blank ones as ``missing``."""
    named = lambda c: F.when(F.trim(c) != "", F.trim(c)).otherwise("missing") if c in built.columns else F.lit("missing")
    return stratified_splits(case_control_rows(built), stored=True).withColumns(
        {"model_sex_category": named("sex_category"), "model_ancestry_pred": F.lower(named("ancestry_pred"))}
    )


def stratified_splits(
    people: DataFrame, outcome: str = "analysis_case", train_fraction: float = 0.8, folds: int = 5, stored: bool = False
) -> DataFrame:
    """Cases and controls are split separately, each in hash order of the person id.

    ``stored``: the people are read from a written table, so they are not written once more.
    """
    people = people if stored else cut_lineage(people)  # read twice below: to rank, and to label
    hashed = people.withColumn("_hash", hash_hex("person_id"))
    slim = cut_lineage(hashed.select("person_id", outcome, "_hash").filter(F.col(outcome).isin(0, 1)))
    totals = slim.groupBy(outcome).agg(F.count(F.lit(1)).alias("_total"))
    ranked = global_rank(slim, [F.col("_hash"), F.col("person_id")], "_rank", groups=[outcome], stored=True).join(
        F.broadcast(totals), outcome  # two rows
    )
    test = _test_count(F.col("_total"), train_fraction)
    is_test = F.col("_rank") <= test
    labels = ranked.select(
        "person_id",
        F.when(is_test, "test").otherwise("train").alias("analysis_split"),
        F.when(~is_test, (F.col("_rank") - test - 1) % folds + 1).cast("int").alias("cv_fold"),
    )
    return people.join(labels, "person_id", "left")


def _split_labels(has_fold: bool) -> Column:
    labels = [F.lit("all"), F.col("analysis_split")]
    if has_fold:
        labels.append(
            F.when(F.col("cv_fold").isNotNull(), F.concat(F.lit("train_cv_fold_"), F.col("cv_fold").cast("string")))
        )
    return F.array_compact(F.array(*labels))


def ratio_text(controls: Column, cases: Column) -> Column:
    return F.when(cases > 0, F.format_string("%.2f", controls / F.nullif(cases, F.lit(0)))).otherwise("")


def split_summary(split: DataFrame, outcome: str = "analysis_case") -> DataFrame:
    """Rows, groups, cases, controls for all, train, test and each fold, in one pass."""
    group = "match_group_id" if "match_group_id" in split.columns else "person_id"
    y = F.coalesce(F.col(outcome), F.lit(0))
    return (
        split.select(
            F.explode(_split_labels("cv_fold" in split.columns)).alias("group"), F.col(group).alias("_g"), y.alias("_y")
        )
        .groupBy("group")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("_g").alias("n_match_groups"),
            F.count_if(F.col("_y") == 1).alias("n_cases"),
            F.count_if(F.col("_y") == 0).alias("n_controls"),
        )
        .withColumn("controls_per_case", ratio_text(F.col("n_controls"), F.col("n_cases")))
    )


def row_flag(df: DataFrame, *columns: str) -> Column:
    """1 when any of the present columns is ≥ 1; NULL counts as 0."""
    present = [F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in columns if c in df.columns]
    if not present:
        return F.lit(0)
    return (F.greatest(*present, F.lit(0.0)) >= 1).cast("int")


def with_case_group_flags(df: DataFrame, outcome: str, flags: dict[str, tuple[str, ...]]) -> DataFrame:
    """Maximum of each flag over the case rows of the match group, mapped to every row of the group."""
    group = "match_group_id" if "match_group_id" in df.columns else "person_id"
    per_group = (
        df.filter(F.col(outcome) == 1)
        .groupBy(group)
        .agg(*[F.max(row_flag(df, *columns)).alias(out) for out, columns in flags.items()])
    )
    return df.join(per_group, group, "left").na.fill(0, list(flags))


def eligibility_flags(df: DataFrame, outcome: str = "analysis_case") -> DataFrame:
    crush = ("preindex_crush_injury", "periindex_crush_injury")
    core = ("age_at_index", "observation_days", "condition_dates")
    complete = F.lit(True)
    for c in core:
        complete = complete & (F.col(c).try_cast("double").isNotNull() if c in df.columns else F.lit(False))
    df = with_case_group_flags(
        df,
        outcome,
        {
            "matched_case_preperi_crush_injury": crush,
            "matched_case_preindex_sepsis": ("preindex_sepsis",),
            "matched_case_periindex_sepsis": ("periindex_sepsis",),
        },
    )
    df = df.withColumns(
        {
            "row_preperi_crush_injury": row_flag(df, *crush),
            "row_preindex_sepsis": row_flag(df, "preindex_sepsis"),
            "row_periindex_sepsis": row_flag(df, "periindex_sepsis"),
            "clinical_model_complete_core": complete.cast("int"),
        }
    )
    nontrauma = (
        (F.col("row_preperi_crush_injury") == 0)
        & (F.col("matched_case_preperi_crush_injury") == 0)
        & (F.col("clinical_model_complete_core") == 1)
    )
    no_sepsis = (F.col("row_periindex_sepsis") == 0) & (F.col("matched_case_periindex_sepsis") == 0)
    return df.withColumns(
        {
            "nontraumatic_model_eligible": nontrauma.cast("int"),
            "primary_model_eligible": nontrauma.cast("int"),
            "sensitivity_no_periindex_sepsis_eligible": (nontrauma & no_sepsis).cast("int"),
            "sensitivity_include_trauma_eligible": F.col("clinical_model_complete_core"),
        }
    )


ELIGIBILITY_SETS = (
    ("primary_model_eligible", "primary_nontraumatic"),
    ("sensitivity_no_periindex_sepsis_eligible", "sensitivity_no_periindex_sepsis"),
    ("sensitivity_include_trauma_eligible", "sensitivity_include_trauma"),
)


def eligibility_summary(df: DataFrame, outcome: str = "analysis_case") -> DataFrame:
    group = "match_group_id" if "match_group_id" in df.columns else "person_id"
    sets = F.array(
        *[F.struct(F.lit(name).alias("eligibility_set"), F.col(flag).alias("_in")) for flag, name in ELIGIBILITY_SETS]
    )
    inside = F.col("_in") == 1
    y = F.coalesce(F.col(outcome), F.lit(0))
    return (
        df.select(
            F.explode(F.array_compact(F.array(F.lit("all"), F.col("analysis_split")))).alias("split"),
            F.col(group).alias("_g"),
            y.alias("_y"),
            sets.alias("_sets"),
        )
        .select("split", "_g", "_y", F.inline("_sets"))
        .groupBy("eligibility_set", "split")
        .agg(
            F.count_if(inside).alias("n_rows"),
            F.count_distinct(F.when(inside, F.col("_g"))).alias("n_match_groups"),
            F.count_if(inside & (F.col("_y") == 1)).alias("n_cases"),
            F.count_if(inside & (F.col("_y") == 0)).alias("n_controls"),
            F.count_if(~inside).alias("excluded_rows"),
            F.count_if(~inside & (F.col("_y") == 1)).alias("excluded_cases"),
            F.count_if(~inside & (F.col("_y") == 0)).alias("excluded_controls"),
        )
        .withColumn("controls_per_case", ratio_text(F.col("n_controls"), F.col("n_cases")))
    )


# The model-input columns, in their public order.
MODEL_COLUMNS = (
    "person_id",
    "analysis_case",
    "analysis_split",
    "cv_fold",
    "primary_model_eligible",
    "nontraumatic_model_eligible",
    "sensitivity_no_periindex_sepsis_eligible",
    "sensitivity_include_trauma_eligible",
    "clinical_model_complete_core",
    "eligible_control",
    "eligible_denominator",
    "matched_case_preperi_crush_injury",
    "row_preperi_crush_injury",
    "matched_case_preindex_sepsis",
    "matched_case_periindex_sepsis",
    "row_preindex_sepsis",
    "row_periindex_sepsis",
    "match_group_id",
    "match_role",
    "matched_case_person_id",
    "case_tier",
    "broad_case",
    "definite_case",
    "high_without_target",
    "index_date",
    "age_at_index",
    "observation_days",
    "condition_dates",
    "model_sex_category",
    "sex_category",
    "is_female",
    "model_ancestry_pred",
    "ancestry_pred",
    "pc1",
    "pc2",
    "pc3",
    "pc4",
    "pc5",
    "pc6",
    "pc7",
    "pc8",
    "pc9",
    "pc10",
    "preindex_crush_injury",
    "remote_preindex_sepsis",
    "near_preindex_sepsis",
    "preindex_sepsis",
    "remote_preindex_renal_injury",
    "near_preindex_renal_injury",
    "preindex_renal_injury",
    "periindex_crush_injury",
    "periindex_sepsis",
    "periindex_renal_injury",
    "postindex_sepsis",
    "postindex_renal_injury",
)


def model_input(df: DataFrame, outcome: str = "analysis_case") -> DataFrame:
    """Ordered model-input projection with the derived defaults for absent columns."""
    if "primary_model_eligible" not in df.columns:
        df = eligibility_flags(df, outcome)
    tier, y = F.lower("case_tier"), F.col(outcome)
    derived = {
        "eligible_control": ((y == 0) & (tier == "control")).cast("int"),
        "broad_case": ((y == 1) & tier.isin("broad", "definite")).cast("int"),
        "definite_case": ((y == 1) & (tier == "definite")).cast("int"),
        "high_without_target": (tier == "indeterminate_ck_only").cast("int"),
    }
    if "condition_dates" in df.columns:
        derived["eligible_denominator"] = (F.coalesce("condition_dates", F.lit(0)) >= 2).cast("int")
    df = df.withColumns({k: v for k, v in derived.items() if k not in df.columns})
    extra = {}
    if "sex_category" in df.columns:
        c = normalised_category("sex_category")
        extra["model_sex_category"] = F.when(c.isin("female", "male", "missing"), c).otherwise("other_or_unknown")
    if "ancestry_pred" in df.columns:
        extra["model_ancestry_pred"] = category_or_missing("ancestry_pred")
    return select_available(df.withColumns(extra) if extra else df, MODEL_COLUMNS)
