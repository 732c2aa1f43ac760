"""Pre-index case profile: event availability, top concepts, biomarker coverage, observation history.

Windows are an array column exploded per event, so every window and every biomarker comes from one scan;
events are collapsed to (person, concept, day) counts before windows multiply them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright.operators.ranking import exact_quantiles
from casewright.session import cut_lineage

Windows = Sequence[tuple[str, int | None]]

# Biomarker name → case-insensitive name terms.
BIOMARKER_TERMS: dict[str, tuple[str, ...]] = {
    "creatine_kinase": ("creatine kinase",),
    "creatinine": ("creatinine",),
    "egfr": ("estimated glomerular filtration", "egfr"),
    "ast": ("aspartate aminotransferase",),
    "alt": ("alanine aminotransferase",),
    "potassium": ("potassium",),
    "sodium": ("sodium",),
    "calcium": ("calcium",),
    "phosphate": ("phosphate", "phosphorus"),
    "bicarbonate": ("bicarbonate", "carbon dioxide"),
    "magnesium": ("magnesium",),
    "tsh": ("thyrotropin", "thyroid stimulating hormone"),
    "glucose": ("glucose",),
    "hemoglobin_a1c": ("hemoglobin a1c", "glycated hemoglobin"),
    "lactate": ("lactate",),
}


def case_frame(cohort: DataFrame, tier: str = "broad") -> DataFrame:
    cases = cohort.filter(F.col("broad_case") == 1 if tier == "broad" else F.col("case_tier") == tier)
    return cases.filter(F.col("index_date").isNotNull()).select(
        "person_id",
        "case_tier",
        "index_date",
        "obs_start_date",
        F.datediff("index_date", "obs_start_date").alias("preindex_observation_days"),
    )


def preindex_events(events: DataFrame, cases: DataFrame, value: str | None = None) -> DataFrame:
    """Events strictly before the person's index date, counted per (person, concept, day[, value]) as ``n``.

    Counting first keeps a heavily recorded person small before the join shuffles on person.
    """
    keys = ["person_id", "concept_id", "concept_name", "event_date", *([value] if value else [])]
    return (
        events.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .join(cases.select("person_id", "index_date"), "person_id")
        .withColumn("days_before", F.datediff("index_date", "event_date"))
        .filter(F.col("days_before") > 0)
        .drop("index_date")
    )


def window_labels(windows: Windows, days: Column) -> Column:
    return F.array_compact(
        F.array(*[F.lit(label) if d is None else F.when(days.between(1, d), F.lit(label)) for label, d in windows])
    )


def _grid(df: DataFrame, windows: Windows) -> DataFrame:
    return df.sparkSession.createDataFrame([(w, i) for i, (w, _) in enumerate(windows)], "window string, window_order int")


def _case_total(cases: DataFrame) -> DataFrame:
    return cases.agg(F.count_distinct("person_id").alias("n_cases"))


def _pct(n: Column, total: Column) -> Column:
    return F.coalesce(F.round(n * 100.0 / F.nullif(total, F.lit(0)), 2), F.lit(0.0))


def event_summary(events: DataFrame, cases: DataFrame, domain: str, windows: Windows) -> DataFrame:
    """Per window: cases with any event, total events and the median per case with any."""
    per_day = events.groupBy("person_id", "days_before").agg(F.sum("n").alias("_n"))
    per_person = (
        per_day.withColumn("window", F.explode(window_labels(windows, F.col("days_before"))))
        .groupBy("window", "person_id")
        .agg(F.sum("_n").alias("_n"))
    )
    agg = per_person.groupBy("window").agg(
        F.count(F.lit(1)).alias("_any"),
        F.sum("_n").alias("_events"),
        F.percentile("_n", F.lit(0.5)).alias("median_events_per_case_with_any"),
    )
    return (
        _grid(events, windows)
        .join(agg, "window", "left")
        .crossJoin(F.broadcast(_case_total(cases)))  # one row
        .select(
            F.lit(domain).alias("domain"),
            "window",
            "n_cases",
            F.coalesce("_any", F.lit(0)).alias("n_cases_with_any"),
            _pct(F.coalesce("_any", F.lit(0)), F.col("n_cases")).alias("pct_cases_with_any"),
            F.coalesce("_events", F.lit(0)).alias("total_events"),
            "median_events_per_case_with_any",
        )
    )


def top_concepts(events: DataFrame, domain: str, windows: Windows, top_n: int) -> DataFrame:
    """The ``top_n`` concepts per window by distinct cases, then events, then name."""
    per_day = events.groupBy(
        "person_id",
        F.col("concept_id").cast("string").alias("concept_id"),
        F.coalesce("concept_name", F.col("concept_id").cast("string")).alias("concept_name"),
        "days_before",
    ).agg(F.sum("n").alias("_n"))
    grouped = (
        per_day.withColumn("window", F.explode(window_labels(windows, F.col("days_before"))))
        .groupBy("window", "concept_id", "concept_name")
        .agg(
            F.count_distinct("person_id").alias("n_cases"),
            F.sum("_n").alias("total_events"),
            F.percentile("days_before", F.lit(0.5), F.col("_n")).alias("median_days_before_index"),
        )
    )
    w = Window.partitionBy("window").orderBy(
        F.desc("n_cases"), F.desc("total_events"), F.asc("concept_name"), F.asc("concept_id")
    )
    return (
        grouped.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= top_n)
        .select(
            F.lit(domain).alias("domain"), "window", "concept_id", "concept_name", "n_cases", "total_events",
            "median_days_before_index", "rank",
        )
    )


def biomarker_availability(
    measurements: DataFrame,
    cases: DataFrame,
    windows: Windows,
    terms: Mapping[str, Sequence[str]] = BIOMARKER_TERMS,
) -> DataFrame:
    """Coverage and median value per (biomarker, window); an event counts once per biomarker, zero rows stay."""
    name = F.lower("concept_name")
    tags = F.array_compact(
        F.array(
            *[
                F.when(
                    F.coalesce(F.greatest(*[name.contains(t.lower()) for t in ts], F.lit(False)), F.lit(False)),
                    F.lit(marker),
                )
                for marker, ts in terms.items()
            ]
        )
    )
    labelled = measurements.select("person_id", "value", "n", tags.alias("_tags"), window_labels(windows, F.col("days_before")).alias("_windows"))
    # written once: the counts and the medians read it; rows without a tag go at the explode, since a filter on tags would
    # move below the join and match terms on every event
    held = cut_lineage(labelled)
    tagged = held.withColumn("biomarker", F.explode("_tags")).withColumn("window", F.explode("_windows")).drop("_tags", "_windows")
    agg = tagged.groupBy("biomarker", "window").agg(
        F.count_distinct("person_id").alias("_people"), F.sum("n").alias("_rows")
    )
    medians = exact_quantiles(tagged, "value", {"median_value": 0.5}, ["biomarker", "window"], F.col("n"))
    spark = measurements.sparkSession
    grid = spark.createDataFrame(
        [(m, w) for m in terms for w, _ in windows], "biomarker string, window string"
    )
    return (
        grid.join(agg, ["biomarker", "window"], "left")
        .join(medians, ["biomarker", "window"], "left")
        .crossJoin(F.broadcast(_case_total(cases)))  # one row
        .select(
            "biomarker",
            "window",
            "n_cases",
            F.coalesce("_people", F.lit(0)).alias("n_cases_with_measurement"),
            _pct(F.coalesce("_people", F.lit(0)), F.col("n_cases")).alias("pct_cases_with_measurement"),
            F.coalesce("_rows", F.lit(0)).alias("total_measurements"),
            "median_value",
        )
    )


def observation_history(cases: DataFrame, windows: Windows) -> DataFrame:
    """Cases with any, and with at least d, pre-index observation days."""
    days = F.col("preindex_observation_days")
    tests = [("preindex", days > 0)] + [(f">={label}", days >= d) for label, d in windows if d is not None]
    wide = cases.agg(
        F.count_distinct("person_id").alias("n_cases"),
        *[F.count_if(t).alias(f"_{i}") for i, (_, t) in enumerate(tests)],
    )
    rows = F.array(
        *[F.struct(F.lit(w).alias("window"), F.col(f"_{i}").alias("n_cases_with_any")) for i, (w, _) in enumerate(tests)]
    )
    return wide.select(F.lit("observation_history").alias("domain"), "n_cases", F.inline(rows)).withColumn(
        "pct_cases_with_any", _pct(F.col("n_cases_with_any"), F.col("n_cases"))
    )
