"""Discrimination, calibration and per-SD effect of scores, grouped and distributed.

``scored`` frames hold ``person_id``, an outcome ``y`` (0/1), ``score`` and optional group columns and an
integer ``weight`` (copies of the row, used by the bootstrap). Ties are ordered by person id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright.functions.distributions import fisher_p, two_sided_p
from casewright.operators.ranking import exact_quantiles, global_rank, global_scan
from casewright.session import BROADCAST_LIMIT_BYTES, cut_lineage, cut_union, parallelism


def exact_mean(value: Column) -> Column:
    """Mean by a decimal sum and one division, so that it does not depend on the order of the rows."""
    return F.sum(value.cast("decimal(38,18)")).cast("double") / F.count(value)


def _same(left: str, right: str, groups: Sequence[str]) -> Column | list[Column]:
    return [F.col(f"{left}.{g}").eqNullSafe(F.col(f"{right}.{g}")) for g in groups]


def attach(df: DataFrame, per_group: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Add group-level columns; without groups ``per_group`` is a single row."""
    if not groups:
        return df.crossJoin(F.broadcast(per_group))
    extra = [c for c in per_group.columns if c not in groups]
    return df.alias("l").join(per_group.alias("r"), _same("l", "r", groups)).select("l.*", *[f"r.{c}" for c in extra])


def _weighted(scored: DataFrame) -> DataFrame:
    base = scored if "weight" in scored.columns else scored.withColumn("weight", F.lit(1))
    return base.filter(F.col("score").isNotNull() & F.col("y").isin(0, 1))


def descending(scored: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Running true and false positives over (score desc, person id), written once for every curve metric."""
    w = F.col("weight")
    return cut_lineage(
        global_scan(
            _weighted(scored),
            [F.col("score").desc(), F.col("person_id").asc()],
            {"tp": (F.when(F.col("y") == 1, w).otherwise(0), "sum"), "fp": (F.when(F.col("y") == 0, w).otherwise(0), "sum")},
            groups,
        )
    )


def discrimination(scored: DataFrame, groups: Sequence[str] = (), scanned: DataFrame | None = None) -> DataFrame:
    """n, cases, controls, ROC AUC (ties count half) and average precision per group."""
    rows = descending(scored, groups) if scanned is None else scanned
    w, y = F.col("weight"), F.col("y")
    # a row standing for w copies: its j-th copy has precision (tp-w+j)/(tp+fp-w+j)
    hits = F.aggregate(
        F.sequence(F.lit(1), w.cast("int")),
        F.lit(0.0),
        lambda acc, j: acc + (F.col("tp") - w + j) / (F.col("tp") + F.col("fp") - w + j),
    )
    precision = F.when(w == 1, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(hits)
    blocks = rows.groupBy(*groups, "score").agg(
        F.sum(F.when(y == 1, w).otherwise(0)).alias("pos"),
        F.sum(F.when(y == 0, w).otherwise(0)).alias("neg"),
        F.max("fp").alias("fp_end"),
        F.sum(F.when(y == 1, precision)).alias("ap"),
    )
    totals = blocks.groupBy(*groups).agg(F.sum("pos").alias("cases"), F.sum("neg").alias("controls"))
    area = F.col("pos") * (F.col("controls") - F.col("fp_end") + F.col("neg") / 2.0)
    return (
        attach(blocks, totals, groups)
        .groupBy(*groups)
        .agg(
            F.max("cases").alias("cases"),
            F.max("controls").alias("controls"),
            F.sum(area).alias("_area"),
            F.sum("ap").alias("_ap"),
        )
        .select(
            *groups,
            (F.col("cases") + F.col("controls")).alias("n"),
            "cases",
            "controls",
            F.when(
                (F.col("cases") > 0) & (F.col("controls") > 0),
                F.col("_area") / F.nullif(F.col("cases") * F.col("controls"), F.lit(0)),
            ).alias("roc_auc"),
            F.when(F.col("cases") > 0, F.col("_ap") / F.nullif(F.col("cases"), F.lit(0))).alias("average_precision"),
        )
    )


def probability_errors(scored: DataFrame, groups: Sequence[str] = (), eps: float = 1e-12) -> DataFrame:
    """Brier score and log-loss (clipped) per group."""
    p = F.least(F.greatest(F.col("score"), F.lit(eps)), F.lit(1 - eps))
    y = F.col("y")
    return _weighted(scored).groupBy(*groups).agg(
        F.avg((F.col("score") - y) * (F.col("score") - y)).alias("brier_score"),
        F.avg(-(y * F.log(p) + (1 - y) * F.log(F.lit(1.0) - p))).alias("log_loss"),
    )


def youden_threshold(scored: DataFrame, groups: Sequence[str] = (), scanned: DataFrame | None = None) -> DataFrame:
    """Score with the largest sensitivity − false positive rate; the larger score wins a tie."""
    rows = descending(scored, groups) if scanned is None else scanned
    ends = rows.groupBy(*groups, "score").agg(F.max("tp").alias("tp"), F.max("fp").alias("fp"))
    totals = ends.groupBy(*groups).agg(F.max("tp").alias("_p"), F.max("fp").alias("_n"))
    youden = F.col("tp") / F.greatest(F.col("_p"), F.lit(1)) - F.col("fp") / F.greatest(F.col("_n"), F.lit(1))
    return attach(ends, totals, groups).groupBy(*groups).agg(
        F.max(F.struct(youden.alias("youden"), F.col("score").alias("threshold"))).alias("_b")
    ).select(*groups, "_b.threshold", "_b.youden")


def confusion(scored: DataFrame, threshold: float | Column, groups: Sequence[str] = ()) -> DataFrame:
    cut = F.lit(threshold) if not isinstance(threshold, Column) else threshold
    hit, y = F.col("score") >= cut, F.col("y")
    agg = _weighted(scored).groupBy(*groups).agg(
        F.count_if(hit & (y == 1)).alias("tp"),
        F.count_if(hit & (y == 0)).alias("fp"),
        F.count_if(~hit & (y == 0)).alias("tn"),
        F.count_if(~hit & (y == 1)).alias("fn"),
    )
    share = lambda a, b: F.when(F.expr(b) > 0, F.expr(a) / F.nullif(F.expr(b), F.lit(0)))
    return agg.withColumns(
        {
            "sensitivity": share("tp", "tp + fn"),
            "specificity": share("tn", "tn + fp"),
            "ppv": share("tp", "tp + fp"),
            "npv": share("tn", "tn + fn"),
            "accuracy": share("tp + tn", "tp + fp + tn + fn"),
        }
    )


def model_metrics(scored: DataFrame, threshold: float | Column, groups: Sequence[str] = ()) -> DataFrame:
    """The full metric row: discrimination, probability errors and confusion at a threshold, which may follow from the groups."""
    out = discrimination(scored, groups).withColumn("prevalence", F.col("cases") / F.col("n"))
    out = attach(out, probability_errors(scored, groups), groups)
    return attach(out, confusion(scored, threshold, groups), groups).withColumn("threshold", threshold if isinstance(threshold, Column) else F.lit(threshold))


def evaluation_rows(scored: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Per evaluation set: counts, discrimination, and each class's mean and sample sd of the score."""
    out = discrimination(scored, groups).withColumn("prevalence", F.col("cases") / F.col("n"))
    by = lambda y: F.when(F.col("y") == y, F.col("score"))
    spread = _weighted(scored).groupBy(*groups).agg(
        exact_mean(by(1)).alias("mean_score_case"), exact_mean(by(0)).alias("mean_score_control"),
        F.stddev_samp(by(1)).alias("sd_score_case"), F.stddev_samp(by(0)).alias("sd_score_control"),
    )
    return attach(out, spread, groups)


# The columns of a model comparison, in their order.
COMPARED = ("n", "cases", "controls", "roc_auc", "average_precision", "brier_score", "log_loss", "sensitivity", "specificity", "ppv", "npv")


def model_comparison(tables: dict[str, DataFrame], evaluation_set: str = "test") -> DataFrame:
    """One row for each model: the metric row of its ``evaluation_set``, or its only row; what a model lacks is NULL."""
    out = None
    for name, table in tables.items():
        chosen = table.filter(F.col("evaluation_set") == evaluation_set) if "evaluation_set" in table.columns else table
        have = lambda c: F.col(c) if c in table.columns else F.lit(None)
        kind = lambda c: "bigint" if c in COMPARED[:3] else "double"
        row = chosen.select(F.lit(name).alias("model"), *[have(c).cast(kind(c)).alias(c) for c in COMPARED]).limit(1)
        out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError("no model to compare")
    return out


def curve_points(scored: DataFrame, curve: str, groups: Sequence[str] = ()) -> DataFrame:
    """ROC or precision–recall points in score order, with the conventional first point."""
    rows = descending(scored, groups)
    totals = rows.groupBy(*groups).agg(F.max("tp").alias("_p"), F.max("fp").alias("_n"))
    rows = attach(rows, totals, groups)
    p, n = F.greatest(F.col("_p"), F.lit(1)), F.greatest(F.col("_n"), F.lit(1))
    seen = F.greatest(F.col("tp") + F.col("fp"), F.lit(1))
    x, y = (F.col("fp") / n, F.col("tp") / p) if curve == "roc" else (F.col("tp") / p, F.col("tp") / seen)
    points = rows.select(*groups, (F.col("tp") + F.col("fp")).cast("long").alias("position"), x.alias("x"), y.alias("y"))
    start = totals.select(
        *groups, F.lit(0).cast("long").alias("position"), F.lit(0.0).alias("x"), F.lit(0.0 if curve == "roc" else 1.0).alias("y")
    )
    return points.unionByName(start)


def _ranked(scored: DataFrame, groups: Sequence[str]) -> DataFrame:
    ranked = global_rank(_weighted(scored), [F.col("score"), F.col("person_id")], "_r", groups)
    return attach(ranked, ranked.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")), groups)


def equal_count_bins(scored: DataFrame, bins: int = 10, groups: Sequence[str] = ()) -> DataFrame:
    """Bins of equal size in score order, the first bins one larger when n does not divide."""
    b = F.least(F.lit(bins), F.col("_n"))
    q = F.floor(F.col("_n") / b)
    extra = F.col("_n") % b
    head = extra * (q + 1)
    r = F.col("_r")
    bin_ = F.when(r <= head, F.ceil(r / (q + 1))).otherwise(extra + F.ceil((r - head) / q))
    return _ranked(scored, groups).withColumn("bin", bin_.cast("int")).drop("_r", "_n")


def quantile_bins(scored: DataFrame, bins: int = 10, groups: Sequence[str] = ()) -> DataFrame:
    """Quantile cut of the first-rank: bin of rank r is max(1, ceil((r−1)·q/(n−1)))."""
    q = F.least(F.lit(bins), F.col("_n"))
    place = F.ceil((F.col("_r") - 1) * q / F.nullif(F.col("_n") - 1, F.lit(0)))
    return (
        _ranked(scored, groups)
        .withColumn("bin", F.greatest(F.lit(1), F.coalesce(place, F.lit(1))).cast("int"))
        .drop("_r", "_n")
    )


def calibration(binned: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    return binned.groupBy(*groups, "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("score").alias("mean_predicted_probability"),
        F.avg("y").alias("observed_case_fraction"),
    )


def decile_table(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Prevalence, score range and odds ratio against the lowest decile (0.5 added to every cell)."""
    binned = cut_lineage(quantile_bins(scored, bins))
    agg = binned.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("y") == 1).alias("cases"),
        F.count_if(F.col("y") == 0).alias("controls"),
        F.min("score").alias("score_min"),
        F.max("score").alias("score_max"),
    )
    agg = agg.join(exact_quantiles(binned, "score", {"score_median": 0.5}, ["bin"]), "bin")
    lowest = agg.agg(
        F.min_by("cases", "bin").alias("_rc"), F.min_by("controls", "bin").alias("_rk")
    )
    half = lambda c: F.col(c) + 0.5
    odds = half("cases") * half("_rk") / (half("controls") * half("_rc"))
    se = F.sqrt(1 / half("cases") + 1 / half("controls") + 1 / half("_rc") + 1 / half("_rk"))
    return (
        agg.crossJoin(F.broadcast(lowest))  # one row
        .withColumns({"prevalence": F.col("cases") / F.col("n"), "odds_ratio_vs_lowest": odds, "_se": se})
        .withColumns(
            {
                "or_ci_low": F.exp(F.log("odds_ratio_vs_lowest") - 1.96 * F.col("_se")),
                "or_ci_high": F.exp(F.log("odds_ratio_vs_lowest") + 1.96 * F.col("_se")),
                "fisher_p_vs_lowest": fisher_p(F.col("cases"), F.col("controls"), F.col("_rc"), F.col("_rk")),
            }
        )
        .drop("_rc", "_rk", "_se")
    )


def standardised(scored: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Adds ``z``: score centred and scaled by the population sd; NULL for a constant score."""
    base = _weighted(scored)
    w = F.col("weight")
    m = base.groupBy(*groups).agg(
        (F.sum(w * F.col("score")) / F.sum(w)).alias("_mean"), F.sum(w).alias("_w")
    )
    with_mean = attach(base, m, groups)
    dev = F.col("score") - F.col("_mean")
    sd = with_mean.groupBy(*groups).agg(F.sqrt(F.sum(w * dev * dev) / F.sum(w)).alias("_sd"))
    return attach(with_mean, sd, groups).withColumn(
        "z", F.when(F.col("_sd") > 0, (F.col("score") - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0)))
    )


def two_parameter_logistic(data: DataFrame, x: str, groups: Sequence[str] = (), max_iterations: int = 25, tolerance: float = 1e-8) -> DataFrame:
    """Newton fit of y on (1, x) per group by grouped sums; NULL without convergence or with one class.

    The state is one row per group, kept as a table between steps.
    """
    w = F.col("weight") if "weight" in data.columns else F.lit(1)
    slim = cut_lineage(
        data.filter(F.col(x).isNotNull()).groupBy(*groups, "y", F.col(x).alias("_x")).agg(F.sum(w).alias("_w"))
    )
    counts = slim.groupBy(*groups).agg(
        F.sum("_w").alias("n_samples"), F.count_distinct("y").alias("_k"), F.count_distinct("_x").alias("_kx")
    )
    zero = F.lit(0.0)
    state = cut_lineage(
        counts.select(
            *groups, "n_samples", zero.alias("b0"), zero.alias("b1"), F.lit(None).cast("double").alias("se0"),
            F.lit(None).cast("double").alias("se1"),
            ((F.col("_k") < 2) | (F.col("_kx") < 2) | (F.col("n_samples") <= 2)).alias("done"), F.lit(False).alias("ok"),
        )
    )
    for _ in range(max_iterations):
        open_ = state.filter(~F.col("done"))
        if open_.isEmpty():
            break
        rows = attach(slim, open_.select(*groups, "b0", "b1"), groups)
        p = 1.0 / (1.0 + F.exp(-F.least(F.greatest(F.col("b0") + F.col("b1") * F.col("_x"), F.lit(-40.0)), F.lit(40.0))))
        rows = rows.withColumn("_p", p)
        r = F.col("_w") * (F.col("y") - F.col("_p"))
        v = F.col("_w") * F.col("_p") * (1.0 - F.col("_p"))
        sums = rows.groupBy(*groups).agg(
            F.sum(r).alias("g0"), F.sum(r * F.col("_x")).alias("g1"), F.sum(v).alias("h00"),
            F.sum(v * F.col("_x")).alias("h01"), F.sum(v * F.col("_x") * F.col("_x")).alias("h11"),
        )
        det = F.col("h00") * F.col("h11") - F.col("h01") * F.col("h01")
        step = attach(open_, sums.withColumn("_det", det), groups)
        good = F.col("_det") > 1e-10 * F.col("h00") * F.col("h11")
        d = F.nullif(F.col("_det"), F.lit(0.0))
        s0 = (F.col("h11") * F.col("g0") - F.col("h01") * F.col("g1")) / d
        s1 = (F.col("h00") * F.col("g1") - F.col("h01") * F.col("g0")) / d
        small = F.greatest(F.abs(s0), F.abs(s1)) < tolerance
        moved = step.select(
            *groups, "n_samples", (F.col("b0") + F.coalesce(s0, zero)).alias("b0"), (F.col("b1") + F.coalesce(s1, zero)).alias("b1"),
            F.sqrt(F.col("h11") / d).alias("se0"), F.sqrt(F.col("h00") / d).alias("se1"),
            F.coalesce(small | ~good, F.lit(True)).alias("done"), F.coalesce(small & good, F.lit(False)).alias("ok"),
        )
        state = cut_union(state.filter("done"), moved)
    keep = lambda c: F.when(F.col("ok"), F.col(c))
    return state.select(
        *groups, "n_samples", keep("b0").alias("intercept"), keep("b1").alias("beta"), keep("se1").alias("se")
    ).withColumns({"odds_ratio": F.exp("beta"), "p_value": two_sided_p(F.col("beta") / F.col("se"))})


def effect_per_sd(scored: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    fit = two_parameter_logistic(standardised(scored, groups), "z", groups)
    return fit.select(
        *groups, F.col("odds_ratio").alias("or_per_score_sd"), F.col("beta").alias("beta_per_score_sd"),
        F.col("se").alias("se_per_score_sd"), "p_value",
    )


def score_metrics(scored: DataFrame, groups: Sequence[str] = (), probability: bool = False) -> DataFrame:
    """Discrimination plus effect per SD, and probability errors for calibrated scores."""
    out = discrimination(scored, groups).withColumn("prevalence", F.col("cases") / F.col("n"))
    out = _left_attach(out, effect_per_sd(scored, groups), groups)
    return attach(out, probability_errors(scored, groups), groups) if probability else out


def _left_attach(df: DataFrame, per_group: DataFrame, groups: Sequence[str]) -> DataFrame:
    if not groups:
        return df.crossJoin(F.broadcast(per_group))  # one row
    extra = [c for c in per_group.columns if c not in groups]
    return df.alias("l").join(per_group.alias("r"), _same("l", "r", groups), "left").select("l.*", *[f"r.{c}" for c in extra])


def group_summary(scored: DataFrame, groups: Sequence[str]) -> DataFrame:
    """n, mean, population sd, median and quartiles of a score per group."""
    base = scored.filter(F.col("score").isNotNull())
    agg = base.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), exact_mean(F.col("score")).alias("mean"), F.stddev_pop("score").alias("sd")
    )
    return attach(agg, exact_quantiles(base, "score", {"q1": 0.25, "median": 0.5, "q3": 0.75}, groups), groups)


def recalibration(scored: DataFrame) -> DataFrame:
    """One row (intercept, slope, n) of y on logit(p); (0, 1) when it cannot be fitted."""
    from casewright.functions.scalars import logit

    fit = two_parameter_logistic(_weighted(scored).withColumn("z", logit("score")), "z")
    return fit.select(
        F.coalesce("intercept", F.lit(0.0)).alias("intercept"),
        F.coalesce("beta", F.lit(1.0)).alias("slope"),
        F.col("n_samples").alias("n"),
    )


def recalibrated(scored: DataFrame, fit: DataFrame) -> DataFrame:
    from casewright.functions.scalars import logit, sigmoid

    return (
        scored.crossJoin(F.broadcast(fit.select(F.col("intercept").alias("_a"), F.col("slope").alias("_b"))))  # one row
        .withColumn("score", sigmoid(F.col("_a") + F.col("_b") * logit("score")))
        .drop("_a", "_b")
    )


# The multipliers and shifts of the splitmix64 mixer, by which draws are told apart.
MIX_STEP, MIX_FACTORS, MIX_SHIFTS = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB), (30, 27, 31)
#: Bytes of a cell in a task, and draws that it makes at once.
CELL_BYTES, DRAWS = 64, 1 << 20


def _draws(first: int, count: int, seed: int, n: int) -> np.ndarray:
    """Places below ``n`` of the draws ``first`` to ``first + count``: a mix of the draw's number."""
    with np.errstate(over="ignore"):
        x = (np.arange(first, first + count, dtype=np.uint64) + np.uint64(seed)) * np.uint64(MIX_STEP)
        x = (x ^ (x >> np.uint64(MIX_SHIFTS[0]))) * np.uint64(MIX_FACTORS[0])
        x = (x ^ (x >> np.uint64(MIX_SHIFTS[1]))) * np.uint64(MIX_FACTORS[1])
        x ^= x >> np.uint64(MIX_SHIFTS[2])
    return (x % np.uint64(n)).astype(np.int64)


def _harmonic(upto: np.ndarray) -> np.ndarray:
    """Sums of 1/k to ``upto``: a table, and the asymptotic series beyond it."""
    table = np.concatenate([[0.0], np.cumsum(1.0 / np.arange(1, 1001))])
    x = np.maximum(upto, 1000).astype(float)
    far = np.log(x) + np.euler_gamma + 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4)
    return np.where(upto <= 1000, table[np.minimum(upto, 1000)], far)


class Cells:
    """Distinct (score, y) in order of falling score, ties by the cell's first person: all that a resample's metrics need."""

    def __init__(self, score: np.ndarray, y: np.ndarray, n: np.ndarray):
        self.score, self.y, self.bounds = score, y.astype(bool), np.cumsum(n)
        self.blocks = np.flatnonzero(np.diff(score, prepend=np.inf) != 0)

    def resample(self, iteration: int, seed: int) -> np.ndarray:
        """How many of the draws fell into each cell."""
        total = int(self.bounds[-1])
        counts = np.zeros(len(self.bounds), dtype=np.int64)
        for at in range(0, total, DRAWS):
            places = _draws(iteration * total + at, min(DRAWS, total - at), seed, total)
            counts += np.bincount(np.searchsorted(self.bounds, places, side="right"), minlength=len(counts))
        return counts

    def metrics(self, w: np.ndarray) -> tuple[float | None, float | None, float | None]:
        """AUC, average precision and odds ratio per SD of the cells with weights ``w``; NULLs without both classes."""
        pos, neg = np.where(self.y, w, 0), np.where(self.y, 0, w)
        cases, controls = int(pos.sum()), int(neg.sum())
        if not cases or not controls:
            return None, None, None
        by_score = lambda v: np.add.reduceat(v, self.blocks)
        p, q = by_score(pos), by_score(neg)
        area = (p * (controls - np.cumsum(q) + q / 2.0)).sum() / (cases * controls)
        tp, fp = np.cumsum(pos), np.cumsum(neg)
        # the j-th copy of a cell has precision (tp - w + j) / (tp + fp - w + j)
        hits = w - fp * (_harmonic(tp + fp) - _harmonic(tp + fp - w))
        return float(area), float(np.where(self.y, hits, 0.0).sum() / cases), self._odds_ratio(w)

    def _odds_ratio(self, w: np.ndarray, most: int = 25, small: float = 1e-8) -> float | None:
        held = w > 0
        w, y, x = w[held].astype(float), self.y[held].astype(float), self.score[held]
        n = w.sum()
        x = x - (w * x).sum() / n
        sd = math.sqrt((w * x * x).sum() / n)
        if n <= 2 or not sd > 0:
            return None
        x = x / sd
        b = np.zeros(2)
        for _ in range(most):
            p = 1.0 / (1.0 + np.exp(-np.clip(b[0] + b[1] * x, -40, 40)))
            r, v = w * (y - p), w * p * (1 - p)
            g0, g1, h00, h01, h11 = r.sum(), (r * x).sum(), v.sum(), (v * x).sum(), (v * x * x).sum()
            det = h00 * h11 - h01 * h01
            if not det > 1e-10 * h00 * h11:
                return None
            step = np.array([h11 * g0 - h01 * g1, h00 * g1 - h01 * g0]) / det
            b = b + step
            if np.abs(step).max() < small:
                return float(np.exp(b[1]))
        return None


METRICS = ("roc_auc", "average_precision", "or_per_score_sd")


def bootstrap_intervals(scored: DataFrame, iterations: int = 500, seed: int = 20240101, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Percentile intervals of AUC, average precision and OR per SD.

    Every iteration draws n rows with replacement; a draw is a mix of (seed, iteration, draw), so a recomputed task
    draws the same rows. Single-class resamples drop out. Rows equal in score and outcome are one cell, and a tie of
    scores stands in the order of the cells' first people. A task counts an iteration's draws by cell and has its
    metrics from the cells in their one order, so an iteration is one row. Cells beyond ``limit`` bytes are dealt over
    tasks instead: rows are cells x iterations, and the grouped operators take over.
    """
    base = cut_lineage(_weighted(scored).drop("weight"))
    cells = cut_lineage(base.groupBy("score", "y").agg(F.count(F.lit(1)).alias("n"), F.min("person_id").alias("person_id")))
    size = cells.agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("n")).first()
    if not size["cells"]:
        long = base.sparkSession.createDataFrame([], "iteration int, metric string, value double")
    elif size["cells"] * CELL_BYTES <= limit:
        per = _resampled_here(cells, iterations, seed)
        long = per.select("iteration", F.inline(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in METRICS])))
    else:
        long = _resampled_apart(cells, int(size["n"]), iterations, seed)
    long = long.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    # one value per iteration, so an exact percentile aggregate is small
    ci = long.groupBy("metric").agg(
        F.percentile("value", F.lit(0.025)).alias("ci_low"),
        F.percentile("value", F.lit(0.975)).alias("ci_high"),
        F.count(F.lit(1)).alias("iterations_used"),
    )
    point = score_metrics(base)
    points = point.select(
        F.inline(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("point_estimate")) for k in METRICS]))
    )
    return points.join(ci, "metric", "left").withColumn("iterations_requested", F.lit(iterations))


def _resampled_here(cells: DataFrame, iterations: int, seed: int) -> DataFrame:
    """(iteration, metrics): one row for each iteration, from cells whose size was checked."""
    spark = cells.sparkSession
    frame = cells.orderBy(F.col("score").desc(), "person_id").toPandas()
    shared = spark.sparkContext.broadcast(Cells(frame["score"].to_numpy(float), frame["y"].to_numpy(), frame["n"].to_numpy()))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(i, *shared.value.metrics(shared.value.resample(int(i), seed))) for i in frame["id"]]
            yield pd.DataFrame(rows, columns=["iteration", *METRICS]).astype({m: float for m in METRICS})

    tasks = min(iterations, parallelism(spark))
    return spark.range(0, iterations, 1, tasks).mapInPandas(run, "iteration int, " + ", ".join(f"{m} double" for m in METRICS))


def _resampled_apart(cells: DataFrame, n: int, iterations: int, seed: int) -> DataFrame:
    """(iteration, metric, value), from counts by (iteration, cell) that are summed over the tasks of a chunk of draws."""
    spark = cells.sparkSession
    placed = global_scan(cells, [F.col("score").desc(), F.col("person_id")], {"upto": (F.col("n"), "sum")})
    placed = cut_lineage(placed.select("score", "y", "person_id", (F.col("upto") - F.col("n")).alias("since"), "upto"))
    chunks = -(-n // DRAWS)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for job in frame["id"]:
                iteration, at = int(job) // chunks, int(job) % chunks * DRAWS
                place, times = np.unique(_draws(iteration * n + at, min(DRAWS, n - at), seed, n), return_counts=True)
                yield pd.DataFrame({"iteration": iteration, "place": place, "times": times}).astype({"iteration": "int32"})

    drawn = spark.range(0, iterations * chunks).repartition(parallelism(spark)).mapInPandas(run, "iteration int, place bigint, times bigint")
    # places and cells meet in ranges of places
    width = max(1, n // (64 * parallelism(spark)))
    bins = placed.withColumn("bin", F.explode(F.sequence(F.floor(F.col("since") / width), F.floor((F.col("upto") - 1) / width))))
    met = drawn.withColumn("bin", F.floor(F.col("place") / width)).join(bins, "bin").filter((F.col("place") >= F.col("since")) & (F.col("place") < F.col("upto")))
    resampled = cut_lineage(met.groupBy("iteration", "score", "y", "person_id").agg(F.sum("times").alias("weight")))
    per = discrimination(resampled, ["iteration"]).filter((F.col("cases") > 0) & (F.col("controls") > 0))
    per = _left_attach(per, effect_per_sd(resampled, ["iteration"]), ["iteration"])
    return per.select("iteration", F.inline(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in METRICS])))
