"""Score weights, LD clumping and pruning, and per-person scores."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from casewright.functions.scalars import lenient_double, threshold_label
from casewright.operators.metrics import discrimination, effect_per_sd, exact_mean
from casewright.operators.predicates import require_columns
from casewright.operators.ranking import global_rank
from casewright.operators.skew import salted_lookup
from casewright.session import cut_lineage, cut_union, parallelism


def valid_weights(gwas: DataFrame) -> DataFrame:
    """Usable weights: no blank ids or alleles, defined beta and p in [0, 1], and no duplicated id at all."""
    require_columns(gwas, ["variant_id", "effect_allele", "beta", "regression_p"])
    blank = lambda c: F.col(c).isNull() | F.col(c).cast("string").isin("", "nan", "None")
    usable = (
        gwas.select(
            F.col("variant_id").cast("string").alias("variant_id"),
            F.col("effect_allele").cast("string").alias("effect_allele"),
            lenient_double("beta").alias("beta"),
            lenient_double("regression_p").alias("p"),
        )
        .filter(~blank("variant_id") & ~blank("effect_allele"))
        .filter(F.col("beta").isNotNull() & F.col("p").between(0, 1))
    )
    # all copies of a duplicated id go; partial aggregation keeps a hot id cheap
    return (
        usable.groupBy("variant_id")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.min(c).alias(c) for c in ("effect_allele", "beta", "p")],
        )
        .filter("_n = 1")
        .drop("_n")
    )


def sorted_weights(weights: DataFrame) -> DataFrame:
    return weights.orderBy("p", "variant_id")


def restricted_weights(weights: DataFrame, ids: DataFrame | None = None, max_p: float | None = None) -> DataFrame:
    out = weights if ids is None else weights.join(ids.select("variant_id").distinct(), "variant_id", "left_semi")
    return out if max_p is None else out.filter(F.col("p") <= max_p)


def threshold_ranges(spark, thresholds: Sequence[float]) -> DataFrame:
    return spark.createDataFrame(
        [(threshold_label(t), 0.0, float(t)) for t in thresholds], "threshold_label string, lower double, upper double"
    )


# LD selection ------------------------------------------------------------------------------------

def _single_sums(rows: DataFrame) -> DataFrame:
    """Per variant: sum, sum of squares and missing calls of ``x``."""
    x = F.col("x")
    return rows.groupBy("variant_id").agg(
        F.coalesce(F.sum(x), F.lit(0.0)).alias("s"), F.coalesce(F.sum(x * x), F.lit(0.0)).alias("ss"), F.count_if(x.isNull()).alias("m")
    )


def _shared_sums(both: DataFrame) -> DataFrame:
    """Per pair, over people listed for both: products, common missing calls, and what one side loses to the other's."""
    x, y = F.col("x"), F.col("y")
    return both.groupBy("lead", "variant_id").agg(
        F.sum(x * y).alias("xy"),
        F.count_if(x.isNull() & y.isNull()).alias("mm"),
        F.sum(F.when(y.isNull(), x)).alias("dx"),
        F.sum(F.when(y.isNull(), x * x)).alias("dxx"),
        F.sum(F.when(x.isNull(), y)).alias("dy"),
        F.sum(F.when(x.isNull(), y * y)).alias("dyy"),
    )


def _r2_of(pairs: DataFrame, shared: DataFrame, single: DataFrame, n_people: int) -> DataFrame:
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    own = single.select("variant_id", F.col("s").alias("sx"), F.col("ss").alias("sxx"), F.col("m").alias("mx"))
    other = single.select(F.col("variant_id").alias("lead"), F.col("s").alias("sy"), F.col("ss").alias("syy"), F.col("m").alias("my"))
    joined = (
        pairs.select("lead", "variant_id").join(shared, ["lead", "variant_id"], "left").join(own, "variant_id", "left").join(other, "lead", "left")
    )
    n = F.lit(float(n_people)) - zero("mx") - zero("my") + zero("mm")
    sx, sy = zero("sx") - zero("dx"), zero("sy") - zero("dy")
    sxx, syy = zero("sxx") - zero("dxx"), zero("syy") - zero("dyy")
    cov = n * zero("xy") - sx * sy
    var = (n * sxx - sx * sx) * (n * syy - sy * sy)
    return joined.select("lead", "variant_id", F.when(var > 0, cov * cov / F.nullif(var, F.lit(0.0))).alias("r2"))


def pair_r2(pairs: DataFrame, calls: DataFrame, n_people: int) -> DataFrame:
    """r² of the given (lead, variant_id) pairs over people with both calls.

    Calls are sparse: an absent row is dosage 0, a NULL ``n_alt`` is missing. Sums over everybody come from
    per-variant totals; only people listed for both variants are joined, on (lead, person).
    """
    rows = calls.select("variant_id", "person_id", F.col("n_alt").cast("double").alias("x"))
    lead_rows = pairs.select("lead").distinct().join(rows.withColumnRenamed("variant_id", "lead"), "lead").select(
        "lead", "person_id", F.col("x").alias("y")
    )
    both = pairs.join(rows, "variant_id").join(lead_rows, ["lead", "person_id"])
    return _r2_of(pairs, _shared_sums(both), _single_sums(rows), n_people)


def _blocks_of_pairs(rows: pd.DataFrame, window: int) -> Iterator[pd.DataFrame]:
    """``_SHARED`` of the pairs of one unit and part: products of blocks of variants, over chunks of people.

    ``rows`` are one unit's calls of one part of the people. A pair counts here if its first variant can lead, both lie
    within ``window``, and one of them lies in the unit's own band.
    """
    rows = rows.sort_values("r", kind="stable")
    r, first = np.unique(rows["r"].to_numpy(), return_index=True)
    position, can_lead, own = (rows[c].to_numpy()[first] for c in ("position", "can_lead", "own"))
    column = np.searchsorted(r, rows["r"].to_numpy())
    person = pd.factorize(rows["person_id"])[0]
    x = rows["x"].to_numpy(float)
    missing = np.isnan(x)
    x = np.where(missing, 0.0, x)
    starts = np.append(np.searchsorted(column, np.arange(0, len(r), BLOCK_VARIANTS)), len(column))

    def dense(block: int, values: np.ndarray, people: np.ndarray, size: int) -> np.ndarray:
        at = slice(starts[block], starts[block + 1])
        out = np.zeros((size, min(BLOCK_VARIANTS, len(r) - block * BLOCK_VARIANTS)))
        place = np.searchsorted(people, person[at]) if len(people) else np.zeros(0, dtype=int)
        held = (place < size) & (people[np.minimum(place, size - 1)] == person[at])
        out[place[held], column[at][held] - block * BLOCK_VARIANTS] = values[at][held]
        return out

    for i in range(len(starts) - 1):
        for j in range(i, len(starts) - 1):
            lead, other = (np.arange(k * BLOCK_VARIANTS, min((k + 1) * BLOCK_VARIANTS, len(r))) for k in (i, j))
            met = can_lead[lead][:, None] & (np.abs(position[lead][:, None] - position[other][None, :]) <= window) & (own[lead][:, None] | own[other][None, :]) & (lead[:, None] < other[None, :])
            if not met.any():
                continue
            # people with a call in both blocks; nobody else adds to a product
            both = np.intersect1d(person[starts[i] : starts[i + 1]], person[starts[j] : starts[j + 1]])
            sums = np.zeros((6, len(lead), len(other)))
            for at in range(0, len(both), BLOCK_PERSONS):
                people = both[at : at + BLOCK_PERSONS]
                y, z = dense(i, x, people, len(people)), dense(j, x, people, len(people))
                sums[0] += y.T @ z
                if missing.any():
                    no_y, no_z = dense(i, missing.astype(float), people, len(people)), dense(j, missing.astype(float), people, len(people))
                    for k, (a, b) in enumerate(((no_y, no_z), (no_y, z), (no_y, z * z), (y, no_z), (y * y, no_z)), start=1):
                        sums[k] += a.T @ b
            a, b = np.nonzero(met & (sums != 0).any(axis=0))
            if len(a):
                found = dict(zip(("xy", "mm", "dx", "dxx", "dy", "dyy"), sums[:, a, b]))
                yield pd.DataFrame({"lead_r": r[lead[a]], "other_r": r[other[b]], **found})


_SHARED = "lead_r bigint, other_r bigint, xy double, mm double, dx double, dxx double, dy double, dyy double"
#: Variants of a block, people of a chunk of its matrix, and calls that a task gathers of one unit.
BLOCK_VARIANTS, BLOCK_PERSONS, UNIT_CALLS = 256, 8192, 500_000


def band_r2(variants: DataFrame, calls: DataFrame, n_people: int, window: int) -> DataFrame:
    """(lead, variant_id, r2) of every pair within ±``window`` positions whose first one, by (priority, id), can lead.

    Pairs come from a band join of the variants and single sums from one aggregate. The sums over people with both calls
    are matrix products: a unit is a band, ``window`` wide, with the next one, and a part of the people, as many parts as
    the counted calls need. Inside a task blocks of variants are multiplied, and only a block pair's sums leave it, so
    no row stands for a pair and a person, and each call is sent twice, however many pairs it is in.
    """
    width = max(window, 1)
    attributes = variants.select("variant_id", "chromosome", F.col("position").cast("long").alias("position"), "priority", "can_lead", F.floor(F.col("position") / width).alias("band"))
    # the rank by (priority, id) names a variant, so the smaller one of a pair leads
    placed = cut_lineage(global_rank(attributes, [F.col("priority"), F.col("variant_id")], "r"))
    x = F.col("n_alt").cast("double")
    held = cut_lineage(calls.select("variant_id", "person_id", x.alias("x")).join(placed.drop("priority"), "variant_id"))

    mine = placed.select("chromosome", "band", *[F.col(c).alias(f"l_{c}") for c in ("variant_id", "position", "can_lead", "r")])
    theirs = placed.select(
        "chromosome", F.explode(F.array(F.col("band") - 1, F.col("band"))).alias("band"), F.col("band").alias("r_band"),
        *[F.col(c).alias(f"r_{c}") for c in ("variant_id", "position", "can_lead", "r")],
    )
    met = mine.join(theirs, ["chromosome", "band"]).filter(F.abs(F.col("l_position") - F.col("r_position")) <= window)
    # within one band both orders meet, across bands only one does
    met = met.filter(((F.col("r_band") != F.col("band")) | (F.col("l_r") < F.col("r_r"))) & (F.col("l_r") != F.col("r_r")))
    before = F.col("l_r") < F.col("r_r")
    pick = lambda first, second, c: F.when(before, F.col(f"{first}_{c}")).otherwise(F.col(f"{second}_{c}"))
    pairs = met.filter(pick("l", "r", "can_lead")).select(pick("l", "r", "variant_id").alias("lead"), pick("r", "l", "variant_id").alias("variant_id"))

    sent = held.select(
        "chromosome", F.explode(F.array(F.col("band") - 1, F.col("band"))).alias("unit"), "band", "position", "r", "can_lead", "person_id", "x"
    )
    units = sent.groupBy("chromosome", "unit").agg(F.count(F.lit(1)).alias("n"), F.max((F.col("band") == F.col("unit")).cast("int")).alias("has_own"))
    units = cut_lineage(units.filter("has_own = 1").select("chromosome", "unit", F.ceil(F.col("n") / UNIT_CALLS).alias("parts")))
    keys = ["chromosome", "unit", "part"]
    dealt = sent.join(units, ["chromosome", "unit"]).select(
        "chromosome", "unit", F.pmod(F.xxhash64("person_id"), F.col("parts")).alias("part"), "position", "r", "can_lead",
        (F.col("band") == F.col("unit")).alias("own"), "person_id", "x",
    )
    gathered = dealt.repartition(parallelism(variants.sparkSession), *keys).sortWithinPartitions(*keys)

    def products(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_, waiting = None, []
        for frame in frames:
            for key, rows in frame.groupby(keys, sort=False, dropna=False):
                if key != open_ and waiting:
                    yield from _blocks_of_pairs(pd.concat(waiting), window)
                    waiting = []
                open_ = key
                waiting.append(rows)
        if waiting:
            yield from _blocks_of_pairs(pd.concat(waiting), window)

    parts = gathered.mapInPandas(products, _SHARED)
    summed = parts.groupBy("lead_r", "other_r").agg(*[F.sum(c).alias(c) for c in ("xy", "mm", "dx", "dxx", "dy", "dyy")])
    named = lambda r, name: placed.select(F.col("r").alias(r), F.col("variant_id").alias(name))
    shared = summed.join(named("lead_r", "lead"), "lead_r").join(named("other_r", "variant_id"), "other_r").drop("lead_r", "other_r")
    return _r2_of(pairs, shared, _single_sums(held.select("variant_id", "x")), n_people)


def ld_select(variants: DataFrame, calls: DataFrame, n_people: int, window: int, drop: Column) -> DataFrame:
    """Greedy selection in (priority, id) order; a kept variant drops open ones within ±window where ``drop`` holds.

    ``variants``: chromosome, position, priority, variant_id, can_lead. r² is computed once, the pairs that conflict
    are kept as edges from the earlier to the later variant, and rounds settle the greedy over them: an open variant
    without an open predecessor is kept, what it conflicts with is dropped. Rounds follow the longest chain of
    conflicts, not the variants in a window, and go on until no variant can be kept. Output: (lead, variant_id, r2)
    with one row per kept variant (itself) and one per dropped variant under its first lead.
    """
    open_ = cut_lineage(variants.select("chromosome", F.col("position").cast("long").alias("position"), "priority", "variant_id", "can_lead"))
    near = calls.join(open_.select("variant_id"), "variant_id", "left_semi").select("variant_id", "person_id", "n_alt")
    order = open_.select(F.col("variant_id").alias("lead"), F.col("priority").alias("_lp"))
    edges = cut_lineage(band_r2(open_, near, n_people, window).filter(drop).join(order, "lead"))
    left = cut_lineage(open_.select("variant_id", "can_lead"))
    chosen: DataFrame | None = None
    while True:
        leads = cut_lineage(left.filter("can_lead").join(edges.select("variant_id").distinct(), "variant_id", "left_anti").select("variant_id"))
        if leads.isEmpty():
            break
        dropped = (
            edges.join(leads.withColumnRenamed("variant_id", "lead"), "lead")
            .groupBy("variant_id")
            .agg(F.min(F.struct("_lp", "lead", "r2")).alias("_b"))
            .select(F.col("_b.lead").alias("lead"), "variant_id", F.col("_b.r2").alias("r2"))
        )
        step = cut_union(leads.select(F.col("variant_id").alias("lead"), "variant_id", F.lit(1.0).alias("r2")), dropped)
        chosen = step if chosen is None else cut_union(chosen, step)
        gone = step.select("variant_id")
        left = cut_lineage(left.join(gone, "variant_id", "left_anti"))
        edges = cut_lineage(edges.join(gone, "variant_id", "left_anti").join(gone.withColumnRenamed("variant_id", "lead"), "lead", "left_anti"))
    if chosen is None:
        return open_.select(F.col("variant_id").alias("lead"), "variant_id", F.lit(1.0).alias("r2")).limit(0)
    return chosen


def clump(
    weights: DataFrame,
    positions: DataFrame,
    calls: DataFrame,
    n_people: int,
    p1: float = 1.0,
    p2: float = 1.0,
    r2: float = 0.1,
    kb: int = 250,
) -> DataFrame:
    """Index variants with p ≤ p1 in p order; variants with p ≤ p2 within kb and r² ≥ threshold join their clump."""
    ranked = weights.filter(F.col("p") <= max(p1, p2)).join(positions.select("variant_id", "chromosome", "position"), "variant_id")
    variants = ranked.filter((F.col("p") <= p2) | (F.col("p") <= p1)).select(
        "chromosome", "position", F.col("p").alias("priority"), "variant_id", (F.col("p") <= p1).alias("can_lead")
    )
    return ld_select(variants, calls, n_people, kb * 1000, F.col("r2") >= r2)


def prune(stats: DataFrame, positions: DataFrame, calls: DataFrame, n_people: int, window_variants: int = 200, r2: float = 0.2) -> DataFrame:
    """Variants kept when the higher-MAF variant of every pair with r² above the limit, fewer than
    ``window_variants`` apart in variant order, wins."""
    placed = stats.select("variant_id", "maf").join(positions.select("variant_id", "chromosome", "position"), "variant_id")
    ordered = global_rank(placed, [F.col("position"), F.col("variant_id")], "_k", ["chromosome"])
    variants = ordered.select(
        "chromosome", F.col("_k").alias("position"), (-F.col("maf")).alias("priority"), "variant_id", F.lit(True).alias("can_lead")
    )
    picked = ld_select(variants, calls, n_people, window_variants - 1, F.col("r2") > r2)
    return picked.filter(F.col("lead") == F.col("variant_id")).select("variant_id")


# Scoring -----------------------------------------------------------------------------------------

def person_scores(calls: DataFrame, weights: DataFrame, samples: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Long (person_id, threshold_label, prs_score): Σ beta × effect-allele dosage over variants with p ≤ T.

    Calls count the alternate allele and are sparse. A weight whose effect allele is the reference (``flip``)
    scores 2 − dosage: its 2·beta goes to everyone as a constant and −beta·dosage to carriers. A missing call
    takes the variant's ``mean_dosage`` when the weights carry one, else 0.
    """
    flip = F.coalesce(F.col("flip"), F.lit(False)) if "flip" in weights.columns else F.lit(False)
    mean = F.col("mean_dosage") if "mean_dosage" in weights.columns else F.lit(0.0)
    w = weights.select(
        "variant_id", "p", F.when(flip, -F.col("beta")).otherwise(F.col("beta")).alias("_b"),
        F.when(flip, 2 * F.col("beta")).otherwise(F.lit(0.0)).alias("_const"), F.coalesce(mean, F.lit(0.0)).alias("_mean"),
    )
    within = lambda t: F.col("p") <= t
    constants = w.agg(
        *[F.coalesce(F.sum(F.when(within(t), F.col("_const"))), F.lit(0.0)).alias(f"_c{i}") for i, t in enumerate(thresholds)]
    )
    value = F.coalesce(F.col("n_alt").cast("double"), F.col("_mean")) * F.col("_b")
    sums = (
        salted_lookup(calls.select("variant_id", "person_id", "n_alt"), w, "variant_id", "person_id")
        .groupBy("person_id")
        .agg(*[F.sum(F.when(within(t), value)).alias(f"_s{i}") for i, t in enumerate(thresholds)])
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(threshold_label(t)).alias("threshold_label"),
                F.lit(float(t)).alias("p_threshold"),
                (F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) + F.col(f"_c{i}")).alias("prs_score"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    return (
        samples.select("person_id")
        .distinct()
        .join(sums, "person_id", "left")
        .crossJoin(F.broadcast(constants))  # one row
        .select("person_id", F.inline(entries))
    )


def score_variant_counts(weights: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    wide = weights.agg(*[F.count_if(F.col("p") <= t).alias(f"_{i}") for i, t in enumerate(thresholds)])
    rows = F.array(
        *[
            F.struct(F.lit(threshold_label(t)).alias("threshold_label"), F.col(f"_{i}").alias("n_variants_scored"))
            for i, t in enumerate(thresholds)
        ]
    )
    return wide.select(F.inline(rows))


def prs_metrics(scores: DataFrame, outcomes: DataFrame, weights: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Per threshold: n, variants scored, AUC, means and sds by group, OR per SD and Wald p."""
    scored = cut_lineage(
        scores.join(outcomes.select("person_id", F.col("analysis_case").cast("int").alias("y")), "person_id")
        .withColumnRenamed("prs_score", "score")
        .filter(F.col("score").isNotNull())
    )
    groups = ["threshold_label"]
    by = lambda y: F.when(F.col("y") == y, F.col("score"))
    summary = scored.groupBy(*groups).agg(
        F.max("p_threshold").alias("p_threshold"),
        exact_mean(by(1)).alias("case_mean_prs"),
        exact_mean(by(0)).alias("control_mean_prs"),
        F.stddev_pop(by(1)).alias("case_sd_prs"),
        F.stddev_pop(by(0)).alias("control_sd_prs"),
    )
    found = discrimination(scored, groups).select(
        *groups, F.col("n").alias("n_participants"), F.col("cases").alias("n_cases"), F.col("controls").alias("n_controls"), "roc_auc"
    )
    return (
        found.join(summary, groups)
        .join(score_variant_counts(weights, thresholds), groups, "left")
        .join(effect_per_sd(scored, groups), groups, "left")
        .na.fill(0, ["n_variants_scored"])
    )


def sample_funnel(sample: DataFrame, steps: Sequence[tuple[str, Column]], outcome: str = "analysis_case") -> DataFrame:
    """Distinct people, cases and controls left after each cumulative restriction, in one pass."""
    passed, out, cols = F.lit(True), [], []
    for i, (name, test) in enumerate(steps):
        passed = passed & F.coalesce(test, F.lit(False))
        who = F.when(passed, F.col("person_id"))
        y = F.col(outcome).try_cast("int")
        cols += [
            F.count_distinct(who).alias(f"_p{i}"),
            F.count_if(passed & (y == 1)).alias(f"_a{i}"),
            F.count_if(passed & (y == 0)).alias(f"_b{i}"),
        ]
        out.append(
            F.struct(
                F.lit(i).alias("step_order"), F.lit(name).alias("step"), F.col(f"_p{i}").alias("participants"),
                F.col(f"_a{i}").alias("cases"), F.col(f"_b{i}").alias("controls"),
            )
        )
    return sample.agg(*cols).select(F.inline(F.array(*out)))
