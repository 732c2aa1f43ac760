"""Time-anchored operators: events relative to a per-row anchor date.

Events are first reduced to one sorted array of distinct dates per (person, name). That array is bounded
by the days of a lifetime, whatever the number of raw records, so joining it to the anchored rows never
multiplies rows and a heavily recorded person stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

PERI_START, PERI_END, REMOTE_CUTOFF = -7, 45, -30
ANCHORED_PREFIXES = ("remote_preindex", "near_preindex", "preindex", "periindex", "postindex")


def event_date_arrays(events: DataFrame, names: Sequence[str], name_col: str = "cofactor") -> DataFrame:
    """person_id plus one sorted distinct date array per name (NULL when the person has none)."""
    return events.groupBy("person_id").agg(
        *[
            F.sort_array(F.collect_set(F.when(F.col(name_col) == n, F.col("event_date")))).alias(f"_dates_{n}")
            for n in names
        ]
    )


def any_date_in(dates: Column, anchor: Column, start: int | None, end: int | None) -> Column:
    """Does any date fall in [anchor+start, anchor+end]? A missing bound is open."""

    def inside(d: Column) -> Column:
        delta = F.datediff(d, anchor)
        ok = F.lit(True)
        if start is not None:
            ok = ok & (delta >= start)
        if end is not None:
            ok = ok & (delta <= end)
        return ok

    return F.coalesce(F.exists(dates, inside), F.lit(False))


def anchored_flags(
    rows: DataFrame,
    events: DataFrame | None,
    names: Sequence[str],
    peri_start: int = PERI_START,
    peri_end: int = PERI_END,
) -> DataFrame:
    """Ever, remote-pre, near-pre, pre, peri and post flags of each cofactor against the row's index date.

    Rows may repeat a person with different index dates; each row is judged by its own anchor. With
    ``events=None`` the rows already carry the date arrays.
    """
    if not names:
        return rows
    joined = rows if events is None else rows.join(event_date_arrays(events, names), "person_id", "left")
    windows = {
        "remote_preindex": (None, REMOTE_CUTOFF - 1),
        "near_preindex": (REMOTE_CUTOFF, peri_start - 1),
        "preindex": (None, peri_start - 1),
        "periindex": (peri_start, peri_end),
        "postindex": (peri_end + 1, None),
    }
    anchor = F.col("index_date")
    flags: dict[str, Column] = {}
    for n in names:
        dates = F.col(f"_dates_{n}")
        known = F.coalesce(F.col(n).try_cast("int"), F.lit(0)) if n in rows.columns else F.lit(0)
        flags[n] = F.greatest(known, F.coalesce((F.size(dates) > 0).cast("int"), F.lit(0)))
        for prefix, (start, end) in windows.items():
            flags[f"{prefix}_{n}"] = (anchor.isNotNull() & any_date_in(dates, anchor, start, end)).cast("int")
    return joined.withColumns(flags).drop(*[f"_dates_{n}" for n in names])


def first_event_between(
    rows: DataFrame, events: DataFrame, start_col: str, end_col: str, out: str, open_start: bool = False
) -> DataFrame:
    """Earliest event date inside each row's own date range (``rows`` keyed by ``person_id``)."""
    lower = F.col("event_date") > F.col(start_col) if open_start else F.col("event_date") >= F.col(start_col)
    firsts = (
        events.select("person_id", "event_date")
        .distinct()
        .join(rows.select("person_id", start_col, end_col), "person_id")
        .filter(lower & (F.col("event_date") <= F.col(end_col)))
        .groupBy("person_id")
        .agg(F.min("event_date").alias(out))
    )
    return rows.join(firsts, "person_id", "left")


def nearest_in_window(
    rows: DataFrame, readings: DataFrame, anchor_col: str, start: int, end: int, prefix: str = "nearest"
) -> DataFrame:
    """As-of join: the reading with the smallest |days| to the anchor inside the window; earlier date wins ties."""
    delta = F.datediff("event_date", F.col(anchor_col))
    best = (
        readings.groupBy("person_id", "event_date")
        .agg(F.max("value").alias("value"))
        .join(rows.select("person_id", anchor_col), "person_id")
        .filter(delta.between(start, end))
        .groupBy("person_id")
        .agg(
            F.min(F.struct(F.abs(delta).alias("distance"), F.col("event_date"), F.col("value"))).alias("_best")
        )
        .select(
            "person_id",
            F.col("_best.event_date").alias(f"{prefix}_date"),
            F.col("_best.value").alias(f"{prefix}_value"),
            F.col("_best.distance").alias(f"{prefix}_distance"),
        )
    )
    return rows.join(best, "person_id", "left")


def nearest_prior_timing(cases: DataFrame, events: DataFrame, names: Sequence[str]) -> DataFrame:
    """Nearest event on or before the index date per (case, cofactor), in days before."""
    before = F.datediff("index_date", "event_date")
    return (
        events.select("person_id", "cofactor", "event_date")
        .filter(F.col("cofactor").isin(*names))
        .distinct()
        .join(cases.select("person_id", "index_date"), "person_id")
        .filter(before >= 0)
        .groupBy("person_id", "cofactor")
        .agg(F.min(before).alias("days_before"))
    )


# Prior-event bins as (label, low, high) days before the index date.
PRIOR_BINS = (
    ("same_day", 0, 0),
    ("1_to_7_days_before", 1, 7),
    ("8_to_30_days_before", 8, 30),
    ("31_to_90_days_before", 31, 90),
    ("91_to_365_days_before", 91, 365),
    ("more_than_365_days_before", 366, None),
)


def prior_timing_summary(cases: DataFrame, events: DataFrame, names: Sequence[str]) -> DataFrame:
    """Counts of nearest prior events per (cofactor, bin) with zero bins kept, plus an ``any_prior`` row.

    Percentages are given against all cases and against cases with any prior event; the day quantiles
    appear on the ``any_prior`` row only.
    """
    cases = cases.filter(F.col("index_date").isNotNull()).select("person_id", "index_date").dropDuplicates(["person_id"])
    days = F.col("days_before")
    bins = [
        F.when((days >= low) & (F.lit(True) if high is None else days <= high), F.lit(label))
        for label, low, high in PRIOR_BINS
    ]
    nearest = nearest_prior_timing(cases, events, names)
    per_bin = nearest.groupBy("cofactor").agg(
        F.count(F.lit(1)).alias("n_any"),
        F.percentile(days, F.lit(0.5)).alias("median_days"),
        F.percentile(days, F.lit(0.25)).alias("q1_days"),
        F.percentile(days, F.lit(0.75)).alias("q3_days"),
        *[F.count(b).alias(f"_n{i}") for i, b in enumerate(bins)],
    )
    grid = cases.sparkSession.createDataFrame([(n,) for n in names], "cofactor string")
    total = cases.agg(F.count(F.lit(1)).alias("n_cases"))
    labelled = F.array(
        F.struct(F.lit(0).alias("bin_order"), F.lit("any_prior").alias("timing_bin"), F.col("n_any").alias("n")),
        *[
            F.struct(F.lit(i + 1).alias("bin_order"), F.lit(label).alias("timing_bin"), F.col(f"_n{i}").alias("n"))
            for i, (label, _, _) in enumerate(PRIOR_BINS)
        ],
    )
    is_any = F.col("bin_order") == 0
    return (
        grid.join(per_bin, "cofactor", "left")
        .na.fill(0, ["n_any", *[f"_n{i}" for i in range(len(bins))]])
        .crossJoin(F.broadcast(total))  # one row
        .select("cofactor", "n_cases", "n_any", "median_days", "q1_days", "q3_days", F.inline(labelled))
        .select(
            "cofactor",
            "bin_order",
            "timing_bin",
            "n",
            "n_cases",
            F.when(F.col("n_cases") > 0, F.col("n") * 100.0 / F.nullif(F.col("n_cases"), F.lit(0))).alias("pct_of_cases"),
            F.when(F.col("n_any") > 0, F.col("n") * 100.0 / F.nullif(F.col("n_any"), F.lit(0))).alias("pct_of_any"),
            *[F.when(is_any, F.col(c)).alias(c) for c in ("median_days", "q1_days", "q3_days")],
        )
    )


# Presentation timing bins as (label, low, high) days after the index date.
TIMING_BINS = (
    ("-365 to -91", -365, -91),
    ("-90 to -31", -90, -31),
    ("-30 to -8", -30, -8),
    ("-7 to -1", -7, -1),
    ("index day", 0, 0),
    ("+1 to +7", 1, 7),
    ("+8 to +45", 8, 45),
    ("+46 to +90", 46, 90),
    ("+91 to +365", 91, 365),
)


def timing_histogram(model_input: DataFrame, events: DataFrame, names: Sequence[str]) -> DataFrame:
    """Distinct people per (group, cofactor, timing bin) around the index date, zero cells kept."""
    people = model_input.filter(F.col("index_date").isNotNull()).select(
        "person_id", "index_date", F.when(F.col("analysis_case") == 1, "cases").otherwise("controls").alias("group")
    )
    anchor = F.col("index_date")
    labels = F.array_compact(
        F.array(
            *[
                F.when(
                    any_date_in(F.col(f"_dates_{n}"), anchor, lo, hi),
                    F.struct(F.lit(n).alias("cofactor"), F.lit(text).alias("timing_bin")),
                )
                for n in names
                for text, lo, hi in TIMING_BINS
            ]
        )
    )
    hits = (
        people.join(event_date_arrays(events, names), "person_id")
        .select("group", "person_id", F.inline(labels))
        .groupBy("group", "cofactor", "timing_bin")
        .agg(F.count_distinct("person_id").alias("n"))
    )
    spark = model_input.sparkSession
    grid = spark.createDataFrame(
        [(g, n, i, t) for g in ("cases", "controls") for n in names for i, (t, _, _) in enumerate(TIMING_BINS)],
        "group string, cofactor string, bin_order int, timing_bin string",
    )
    denominators = people.groupBy("group").agg(F.count_distinct("person_id").alias("denominator"))
    return (
        grid.join(denominators, "group", "left")
        .join(hits, ["group", "cofactor", "timing_bin"], "left")
        .select(
            "group",
            "cofactor",
            "bin_order",
            "timing_bin",
            F.coalesce("n", F.lit(0)).alias("n"),
            F.coalesce("denominator", F.lit(0)).alias("denominator"),
            F.when(F.col("denominator") > 0, F.coalesce("n", F.lit(0)) * 100.0 / F.col("denominator")).alias("percent"),
        )
    )
