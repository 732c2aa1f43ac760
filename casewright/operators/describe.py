"""Counts, funnels, missingness and two-group tables. Data passes are aggregates; only small results are formatted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from casewright.functions.distributions import chi2_p, fisher_p, student_critical, student_p, two_sided_p
from casewright.functions.scalars import (
    category_or_missing,
    fmt_ci,
    fmt_count_pct,
    fmt_effect,
    fmt_mean_sd,
    fmt_p,
    fmt_smd,
    is_missing_label,
    lenient_double,
)


def long_counts(df: DataFrame, metrics: Mapping[str, Column], name: str = "metric", value: str = "n") -> DataFrame:
    """All aggregates in one pass, then one row per metric."""
    wide = df.agg(*[v.cast("long").alias(k) for k, v in metrics.items()])
    pairs = F.array(*[F.struct(F.lit(k).alias(name), F.coalesce(F.col(f"`{k}`"), F.lit(0)).alias(value)) for k in metrics])
    return wide.select(F.inline(pairs))


# Count columns that are suppressed, and the largest suppressed count.
SUPPRESSED_COLUMNS = ("n", "count", "n_rows", "cases", "controls", "n_cases", "n_controls", "missing_n", "observed_n")
SUPPRESSION_LIMIT = 20


def suppress_small_counts(df: DataFrame) -> DataFrame:
    """Counts of 1..20 become ``<=20``; zero and larger counts stay, as text."""
    hidden = f"<={SUPPRESSION_LIMIT}"

    def masked(c: str) -> Column:
        return F.when(F.col(c).try_cast("double").between(1, SUPPRESSION_LIMIT), hidden).otherwise(
            F.col(c).cast("string")
        )

    return df.select(*[masked(c).alias(c) if c.lower() in SUPPRESSED_COLUMNS else F.col(c) for c in df.columns])


# Two-group tables --------------------------------------------------------------------------------

def _long_variables(
    df: DataFrame, group: str, by: Sequence[str], continuous: Sequence[str], binary: Sequence[str], categorical: Sequence[str],
    null_as_zero: bool,
) -> DataFrame:
    """One row per (row, variable): x is the value, the 0/1 flag, or 1 for the row's category."""
    number = lambda c: lenient_double(c)
    flag = lambda c: (F.coalesce(number(c), F.lit(0.0)) if null_as_zero else number(c)) >= 1
    cell = lambda kind, c, level, x: F.struct(
        F.lit(kind).alias("kind"), F.lit(c).alias("variable"), level.alias("level"), x.alias("x")
    )
    cells = [cell("continuous", c, F.lit(""), number(c)) for c in continuous if c in df.columns]
    cells += [cell("binary", c, F.lit("yes"), flag(c).cast("double")) for c in binary if c in df.columns]
    cells += [cell("categorical", c, category_or_missing(c), F.lit(1.0)) for c in categorical if c in df.columns]
    return df.select(*by, (F.coalesce(F.col(group), F.lit(0)) == 1).alias("_g"), F.inline(F.array(*cells))).filter(
        F.col("x").isNotNull()
    )


def two_group_table(
    df: DataFrame,
    group: str,
    continuous: Sequence[str] = (),
    binary: Sequence[str] = (),
    categorical: Sequence[str] = (),
    by: Sequence[str] = (),
    null_as_zero: bool = False,
) -> DataFrame:
    """Counts, moments, effect with 95% CI, SMD and p per variable and level, group 1 against group 0.

    The data are read once into (variable, level, group) moments; everything after works on that small
    table. ``null_as_zero`` counts a missing flag as 0; otherwise it leaves the denominator.
    """
    long = _long_variables(df, group, by, continuous, binary, categorical, null_as_zero)
    keys = [*by, "kind", "variable", "level"]
    m = long.groupBy(*keys).agg(
        *[
            agg(F.when(F.col("_g") == g, F.col("x"))).alias(f"{name}{i}")
            for i, g in ((1, True), (0, False))
            for name, agg in (("n", F.count), ("mean", F.avg), ("var", F.var_samp), ("sum", F.sum))
        ]
    )
    # the denominator of a category level is the size of its variable
    totals = m.groupBy(*by, "variable").agg(F.sum("n1").alias("t1"), F.sum("n0").alias("t0"))
    m = m.join(totals, [*by, "variable"])
    return _with_effects(m, by)


def _with_effects(m: DataFrame, by: Sequence[str]) -> DataFrame:
    cont = F.col("kind") == "continuous"
    cat = F.col("kind") == "categorical"
    zero = F.lit(0.0)
    share = lambda a, b: F.when(b > 0, a / F.nullif(b, F.lit(0)))
    n1, n0 = F.when(cat, F.col("t1")).otherwise(F.col("n1")), F.when(cat, F.col("t0")).otherwise(F.col("n0"))
    m = m.withColumns({"n1": n1.cast("double"), "n0": n0.cast("double"), "k1": F.coalesce("sum1", zero), "k0": F.coalesce("sum0", zero)})
    n1, n0, k1, k0 = (F.col(c) for c in ("n1", "n0", "k1", "k0"))
    # continuous
    v1, v0 = F.coalesce("var1", zero), F.coalesce("var0", zero)
    pooled = F.sqrt((v1 + v0) / 2)
    diff = F.col("mean1") - F.col("mean0")
    enough = (n1 >= 2) & (n0 >= 2)
    e1, e0 = v1 / F.nullif(n1, zero), v0 / F.nullif(n0, zero)
    se = F.sqrt(e1 + e0)
    df_ = (e1 + e0) * (e1 + e0) / F.nullif(e1 * e1 / F.nullif(n1 - 1, zero) + e0 * e0 / F.nullif(n0 - 1, zero), zero)
    # binary and category levels
    p1, p0 = share(k1, n1), share(k0, n0)
    spread = F.sqrt((p1 * (1 - p1) + p0 * (1 - p0)) / 2)
    a, b, c, d = k1, n1 - k1, k0, n0 - k0
    fix = F.when(F.least(a, b, c, d) == 0, 0.5).otherwise(0.0)
    none = (a == 0) & (c == 0)
    odds = F.when(~none & (n1 > 0) & (n0 > 0), ((a + fix) * (d + fix)) / F.nullif((b + fix) * (c + fix), zero))
    or_se = F.sqrt(sum((F.try_divide(F.lit(1.0), cell + fix) for cell in (b, c, d)), F.try_divide(F.lit(1.0), a + fix)))
    grand = n1 + n0
    chi2 = grand * (a * d - b * c) * (a * d - b * c) / F.nullif(n1 * n0 * (a + c) * (b + d), zero)
    safe_se = F.nullif(se, zero)
    m = m.withColumns(
        {
            "effect": F.when(cont, F.when(enough, diff)).otherwise(odds),
            "smd": F.when(
                cont, F.when((n1 > 0) & (n0 > 0), F.when(pooled == 0, 0.0).otherwise(diff / F.nullif(pooled, zero)))
            ).otherwise(F.when((n1 > 0) & (n0 > 0), F.when(spread == 0, 0.0).otherwise((p1 - p0) / F.nullif(spread, zero)))),
            "_half": F.when(cont & enough, F.when(se > 0, student_critical(df_) * se).otherwise(0.0)),
            "_orse": or_se,
            "_t": diff / safe_se,
            "_df": df_,
            "_chi2": chi2,
            "_small": (F.least(a, b, c, d) < 5),
            "_none": none,
        }
    )
    is_cont = F.col("kind") == "continuous"
    log_or = F.log("effect")
    # the exact test is evaluated only where it is used: other lines pass NULL counts
    exact = ~is_cont & F.col("_small")
    cells = (F.col("k1"), F.col("n1") - F.col("k1"), F.col("k0"), F.col("n0") - F.col("k0"))
    binary_p = (
        F.when(F.col("_none") | (F.col("n1") == 0) | (F.col("n0") == 0), F.lit(None).cast("double"))
        .when(F.col("_small"), fisher_p(*[F.when(exact, c) for c in cells]))
        .otherwise(two_sided_p(F.sqrt("_chi2")))
    )
    return m.select(
        *by, "kind", "variable", "level",
        F.col("n1").cast("long").alias("n1"), F.col("n0").cast("long").alias("n0"),
        F.when(~is_cont, F.col("k1").cast("long")).alias("count1"), F.when(~is_cont, F.col("k0").cast("long")).alias("count0"),
        F.when(is_cont, F.col("mean1")).alias("mean1"), F.when(is_cont, F.col("mean0")).alias("mean0"),
        F.when(is_cont & (F.col("n1") > 0), F.sqrt(F.coalesce("var1", zero))).alias("sd1"),
        F.when(is_cont & (F.col("n0") > 0), F.sqrt(F.coalesce("var0", zero))).alias("sd0"),
        "effect",
        F.when(is_cont, F.col("effect") - F.col("_half")).otherwise(F.exp(log_or - 1.96 * F.col("_orse"))).alias("ci_low"),
        F.when(is_cont, F.col("effect") + F.col("_half")).otherwise(F.exp(log_or + 1.96 * F.col("_orse"))).alias("ci_high"),
        "smd",
        F.when(is_cont, student_p(F.col("_t"), F.col("_df"))).otherwise(binary_p).alias("p_value"),
    )


def categorical_overall(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per categorical variable: largest |SMD| over its levels and the r×2 χ² p, empty levels dropped."""
    cat = table.filter("kind = 'categorical'")
    e = lambda n: (F.col("count1") + F.col("count0")) * F.col(n) / (F.col("n1") + F.col("n0"))
    term = lambda c, n: (F.col(c) - e(n)) * (F.col(c) - e(n)) / F.nullif(e(n), F.lit(0.0))
    levels = F.col("count1") + F.col("count0") > 0
    agg = cat.groupBy(*by, "variable").agg(
        F.max(F.abs("smd")).alias("smd"),
        F.sum(F.when(levels, term("count1", "n1") + term("count0", "n0"))).alias("_chi2"),
        (F.count_if(levels) - 1).alias("_df"),
    )
    return agg.select(*by, "variable", "smd", F.col("_chi2").alias("chi2"), chi2_p(F.col("_chi2"), F.col("_df")).alias("p_value"))


def format_two_group(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Display text: mean (sd) or n (%), effect, CI, SMD and p."""
    cont = F.col("kind") == "continuous"
    cell = lambda i: F.when(cont, fmt_mean_sd(F.col(f"mean{i}"), F.col(f"sd{i}"))).otherwise(
        fmt_count_pct(F.col(f"count{i}"), F.col(f"n{i}"))
    )
    return table.select(
        *by, "variable", "level", cell(1).alias("cases"), cell(0).alias("controls"),
        F.when(cont, "mean_difference").otherwise("odds_ratio").alias("effect_measure"),
        fmt_effect(F.col("effect")).alias("effect_size"), fmt_ci(F.col("ci_low"), F.col("ci_high")).alias("ci_95"),
        fmt_smd(F.col("smd")).alias("smd"), fmt_p(F.col("p_value")).alias("p_value"),
    )


# Display order of the known categories; others follow alphabetically.
PREFERRED_LEVELS = {
    "sex_category": ("female", "male", "other_or_unknown", "missing"),
    "ancestry_pred": ("AFR", "AMR", "EAS", "EUR", "MID", "SAS", "other", "missing"),
}


def with_level_order(table: DataFrame) -> DataFrame:
    """Adds ``level_order``: preferred categories first, then the rest in text order (NULL keeps them last)."""
    order = F.lit(None).cast("int")
    for variable, levels in PREFERRED_LEVELS.items():
        for i, level in enumerate(levels):
            order = F.when((F.col("variable") == variable) & (F.col("level") == level), i).otherwise(order)
    return table.withColumn("level_order", order)


def flag_summary(groups: DataFrame, flags: Sequence[str], any_of: Mapping[str, Sequence[str]]) -> DataFrame:
    """(group, variable, n, pct): people, each flag and each OR of flags per group. ``groups`` has a ``group`` column."""
    flag = lambda c: lenient_double(c) >= 1
    either = {k: [c for c in cols if c in groups.columns] for k, cols in any_of.items()}
    tests = {c: flag(c) for c in flags if c in groups.columns}
    for name, cols in either.items():
        if len(cols) == len(any_of[name]):
            tests[name] = reduce(or_, [F.coalesce(flag(c), F.lit(False)) for c in cols])
    wide = groups.groupBy("group").agg(
        F.count_distinct("person_id").alias("_people"),
        *[F.count_if(t).alias(f"n_{k}") for k, t in tests.items()],
        *[F.count(t).alias(f"d_{k}") for k, t in tests.items()],
    )
    rows = [F.struct(F.lit("N").alias("variable"), F.col("_people").alias("n"), F.lit(None).cast("double").alias("pct"))]
    rows += [
        F.struct(
            F.lit(k).alias("variable"), F.col(f"n_{k}").alias("n"),
            (F.col(f"n_{k}") * 100.0 / F.nullif(F.col(f"d_{k}"), F.lit(0))).alias("pct"),
        )
        for k in tests
    ]
    return wide.select("group", F.inline(F.array(*rows)))


def missingness(df: DataFrame, variables: Sequence[str], groups: Column) -> DataFrame:
    """Missing and observed counts per (variable, group). ``groups`` is an array of the labels a row belongs to."""
    present = [v for v in variables if v in df.columns]
    types = dict(df.dtypes)
    gone = lambda v: is_missing_label(v) if types[v] == "string" else F.col(v).isNull()
    wide = df.select(F.explode(groups).alias("group"), *[gone(v).cast("int").alias(f"_m{i}") for i, v in enumerate(present)])
    agg = wide.groupBy("group").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"_m{i}").alias(f"_m{i}") for i in range(len(present))])
    rows = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"_m{i}").alias("missing_n")) for i, v in enumerate(present)])
    return agg.select("group", "n", F.inline(rows)).select(
        "variable", "group", "n", (F.col("n") - F.col("missing_n")).alias("observed_n"), "missing_n",
        (F.col("missing_n") * 100.0 / F.nullif(F.col("n"), F.lit(0))).alias("missing_pct"),
    )


def filtered_missingness(report: DataFrame) -> DataFrame:
    return report.filter("missing_n > 0").orderBy(F.desc("missing_pct"), F.desc("missing_n"), "variable")


def consort(built: DataFrame, matched: DataFrame) -> DataFrame:
    """Nine-step flow counts: one pass over the built cohort, one over the matched rows."""
    left = long_counts(
        built,
        {
            "built_rows": F.count(F.lit(1)),
            "eligible_denominator": F.count_if("eligible_denominator"),
            "broad_cases": F.sum("broad_case"),
            "definite_cases": F.sum("definite_case"),
            "indeterminate_excluded": F.count_if(F.col("case_tier") == "indeterminate_ck_only"),
            "eligible_controls": F.count_if("eligible_control"),
        },
        name="step",
    )
    right = long_counts(
        matched,
        {
            "matched_rows": F.count(F.lit(1)),
            "matched_cases": F.count_if(F.col("analysis_case") == 1),
            "matched_controls": F.count_if(F.col("analysis_case") == 0),
        },
        name="step",
    )
    return left.unionByName(right)
