import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewright.functions import distributions as D, scalars as S
from casewright.operators import association, describe, metrics, models, ranking


def brute_fisher(a, b, c, d):
    n, row, col = a + b + c + d, a + b, a + c
    weight = lambda k: math.comb(row, k) * math.comb(n - row, col - k)
    ks = range(max(0, row + col - n), min(row, col) + 1)
    return sum(weight(k) for k in ks if weight(k) <= weight(a)) / math.comb(n, col)


@pytest.mark.parametrize("cells", [(3, 1, 1, 3), (0, 5, 4, 2), (10, 2, 3, 15), (8, 0, 0, 9), (0, 0, 3, 4), (20, 30, 25, 41)])
def test_fisher(cells):
    assert D.fisher_two_sided(*cells) == pytest.approx(brute_fisher(*cells), rel=1e-9)


@pytest.mark.parametrize("counts", [(57, 14, 50), (10, 5, 0), (0, 0, 7), (30, 1, 0), (3, 9, 2)])
def test_hardy_weinberg(counts):
    aa, ab, bb = counts
    n, minor = sum(counts), 2 * min(aa, bb) + ab
    weight = {}
    for h in range(minor % 2, minor + 1, 2):
        r = (minor - h) // 2
        weight[h] = math.factorial(n) * 2**h / (math.factorial(r) * math.factorial(h) * math.factorial(n - h - r))
    total = sum(weight.values())
    p = sum(w for w in weight.values() if w <= weight[ab] * (1 + 1e-9)) / total
    assert D.hardy_weinberg(*counts) == pytest.approx(p, rel=1e-9)
    assert D.hardy_weinberg(*counts, True) == pytest.approx(p - weight[ab] / total / 2, rel=1e-9)


def test_known_tails():
    assert D.chi2_survival(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert D.chi2_survival(18.307038053275146, 10) == pytest.approx(0.05, rel=1e-9)
    assert D.t_two_sided(2.2281388519649385, 10) == pytest.approx(0.05, rel=1e-9)
    assert D.t_critical(10) == pytest.approx(2.2281388519649385, rel=1e-9)
    assert D.chi2_1df_from_p(0.05) == pytest.approx(3.841458820694124, rel=1e-9)
    assert D.normal_two_sided(np.array([1.959963984540054]))[0] == pytest.approx(0.05, rel=1e-9)


def test_global_rank_scan_and_bh(spark):
    rnd = random.Random(4)
    rows = [(f"k{i}", rnd.choice("ab"), rnd.choice([None, 0.5, round(rnd.random(), 2)])) for i in range(120)]
    df = spark.createDataFrame(rows, "id string, g string, p double")
    got = {r.id: r.q for r in ranking.benjamini_hochberg(df, "p", "q", ["id"], ["g"]).collect()}
    for g in "ab":
        part = sorted((p, i) for i, gg, p in rows if gg == g and p is not None)
        n = sum(gg == g for _, gg, _ in rows)
        running = 1.0
        for rank in range(len(part), 0, -1):
            running = min(running, part[rank - 1][0] * n / rank)
            assert got[part[rank - 1][1]] == pytest.approx(running)
    assert all(got[i] is None for i, _, p in rows if p is None)
    ranks = {r.id: r.rank for r in ranking.global_rank(df.filter("p is not null"), [F.col("p"), F.col("id")]).collect()}
    order = sorted((p, i) for i, _, p in rows if p is not None)
    assert [ranks[i] for _, i in order] == list(range(1, len(order) + 1))


def test_exact_quantiles(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice("xy"), rnd.choice([1.0, 2.0, round(rnd.gauss(0, 3), 2)])) for _ in range(151)]
    got = ranking.exact_quantiles(spark.createDataFrame(rows, "g string, v double"), "v", {"q": 0.5, "q3": 0.75}, ["g"])
    for r in got.collect():
        values = [v for g, v in rows if g == r.g]
        assert r.q == pytest.approx(np.quantile(values, 0.5)) and r.q3 == pytest.approx(np.quantile(values, 0.75))


def test_lambda(spark):
    p = [0.001, 0.2, 0.4, 0.9, 1.0, None]
    got = association.genomic_control(spark.createDataFrame([(v,) for v in p], "regression_p double")).first().lambda_gc
    assert got == pytest.approx(np.median([D.chi2_1df_from_p(v) for v in p if v]) / 0.4549364)


def test_two_group_effects(spark):
    rnd = random.Random(2)
    rows = [(int(i < 30), rnd.gauss(50 + 3 * (i < 30), 8), int(rnd.random() < 0.3 + 0.2 * (i < 30))) for i in range(90)]
    df = spark.createDataFrame(rows, "y int, age double, flag int")
    got = {r.variable: r for r in describe.two_group_table(df, "y", ["age"], ["flag"]).collect()}
    a, b = [r[1] for r in rows if r[0]], [r[1] for r in rows if not r[0]]
    va, vb = np.var(a, ddof=1), np.var(b, ddof=1)
    se2 = va / len(a) + vb / len(b)
    dof = se2**2 / ((va / len(a)) ** 2 / (len(a) - 1) + (vb / len(b)) ** 2 / (len(b) - 1))
    diff = np.mean(a) - np.mean(b)
    row = got["age"]
    assert row.effect == pytest.approx(diff) and row.smd == pytest.approx(diff / math.sqrt((va + vb) / 2))
    assert row.p_value == pytest.approx(D.t_two_sided(diff / math.sqrt(se2), dof))
    assert row.ci_low == pytest.approx(diff - D.t_critical(dof) * math.sqrt(se2))
    k1, k0 = sum(r[2] for r in rows if r[0]), sum(r[2] for r in rows if not r[0])
    flag = got["flag"]
    assert flag.effect == pytest.approx(k1 * (60 - k0) / ((30 - k1) * k0))
    chi2 = 90 * (k1 * (60 - k0) - (30 - k1) * k0) ** 2 / (30 * 60 * (k1 + k0) * (90 - k1 - k0))
    assert flag.p_value == pytest.approx(D.chi2_survival(chi2, 1))


def test_display_formats(spark):
    row = spark.sql("select 0.00001D p, 0.25D q, cast(null as double) n, 123.4D e, 3L k, 7L t").select(
        S.fmt_p(F.col("p")), S.fmt_p(F.col("q")), S.fmt_p(F.col("n")), S.fmt_effect(F.col("e")), S.fmt_count_pct(F.col("k"), F.col("t"))
    ).first()
    assert list(row) == ["1.00e-05", "0.2500", "", "1.23e+02", "3 (42.9%)"]


def test_small_count_suppression(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 20), ("d", 21)], "k string, n int")
    assert [r.n for r in describe.suppress_small_counts(df).orderBy("k").collect()] == ["0", "<=20", "<=20", "21"]


def _scored(spark, n=80):
    rnd = random.Random(6)
    rows = [(f"p{i:02d}", int(rnd.random() < 0.4), round(rnd.random(), 1)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "person_id string, y int, score double")


def test_discrimination_bins_and_weights(spark):
    rows, df = _scored(spark)
    pos, neg = [s for _, y, s in rows if y], [s for _, y, s in rows if not y]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    ordered = sorted(rows, key=lambda r: (-r[2], r[0]))
    tp, ap = 0, 0.0
    for i, r in enumerate(ordered, 1):
        tp += r[1]
        ap += r[1] * tp / i
    row = metrics.discrimination(df).first()
    assert row.roc_auc == pytest.approx(auc) and row.average_precision == pytest.approx(ap / len(pos))
    # a weight is the same as repeating the row
    doubled = metrics.discrimination(df.withColumn("weight", F.lit(3))).first()
    assert doubled.roc_auc == pytest.approx(auc) and doubled.n == 3 * row.n
    sizes = sorted(r.n for r in metrics.calibration(metrics.equal_count_bins(df.limit(80).filter("person_id < 'p73'"), 10)).collect())
    assert sizes == sorted(len(c) for c in np.array_split(np.arange(73), 10))


def test_effect_per_sd_and_recalibration(spark):
    rows, df = _scored(spark)
    x = np.array([r[2] for r in rows])
    y = np.array([r[1] for r in rows], float)
    z = (x - x.mean()) / x.std()
    beta, info = association.newton_logistic(np.column_stack([np.ones(len(z)), z]), y)
    row = metrics.effect_per_sd(df).first()
    assert row.beta_per_score_sd == pytest.approx(beta[1], rel=1e-6) and row.se_per_score_sd == pytest.approx(math.sqrt(np.linalg.inv(info)[1, 1]), rel=1e-6)
    one_class = metrics.recalibration(df.filter("y = 1")).first()
    assert (one_class.intercept, one_class.slope) == (0.0, 1.0)


def test_bootstrap_brackets_the_estimate(spark):
    _, df = _scored(spark)
    for r in metrics.bootstrap_intervals(df, iterations=30).collect():
        assert r.iterations_used == 30 and r.ci_low < r.point_estimate < r.ci_high


def test_penalised_fit_matches_newton(spark):
    rnd = random.Random(9)
    rows = [(f"p{i}", int(rnd.random() < 0.4), rnd.gauss(0, 1), rnd.choice(["female", "male", None])) for i in range(200)]
    df = spark.createDataFrame(rows, "person_id string, y int, x double, model_sex_category string")
    specs = models.fit_encoders(df, [("x", "x_per_sd", "identity"), ("absent", "a", "identity")])
    assert [s.feature for s in specs] == ["x_per_sd", "model_sex_category=male", "model_sex_category=missing"]
    model = models.fit_logistic(df, specs, "y", 1.0)
    design = np.array([list(r) for r in df.select(*[s.column() for s in specs]).collect()], float)
    design = np.column_stack([np.ones(len(design)), design])
    y = np.array([r[1] for r in rows], float)
    beta = np.zeros(design.shape[1])
    ridge = np.diag([0.0] + [1.0] * (len(beta) - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        beta += np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + ridge, design.T @ (y - p) - ridge @ beta)
    assert [model.intercept, *model.betas] == pytest.approx(list(beta), abs=1e-4)


def test_parameter_helpers():
    assert S.parse_windows("365,1095,all,365") == [("365d", 365), ("1095d", 1095), ("any_prior", None)]
    assert S.parse_thresholds("0.5,0.01,0.5") == [0.01, 0.5] and S.threshold_label(0.01) == "p0_01"
    assert S.autosomes(["chr2", "2", "7"]) == ["2", "7"] and S.slugify("A b/c") == "a_b_c"
    with pytest.raises(ValueError):
        S.autosomes(["X"])
    assert S.parameter_hash({"b": 1, "a": 2}) == S.parameter_hash({"a": 2, "b": 1})


def test_bootstrap_by_cells_equals_one_by_copies(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    rows = [(f"p{i:03}", int(rng.random() < 0.4), float(rng.integers(0, 6))) for i in range(90)]
    df = spark.createDataFrame(rows, "person_id string, y int, score double")
    near = {r["metric"]: r for r in metrics.bootstrap_intervals(df, iterations=12, seed=5).collect()}
    far = {r["metric"]: r for r in metrics.bootstrap_intervals(df, iterations=12, seed=5, limit=0).collect()}
    # copies of rows, drawn and ranked one by one
    first = {}
    for p, y, s in sorted(rows):
        first.setdefault((s, y), p)
    ordered = sorted(rows, key=lambda r: (-r[2], first[r[2], r[1]], r[0]))
    values = {"roc_auc": [], "average_precision": []}
    for i in range(12):
        drawn = [ordered[k] for k in metrics._draws(i * 90, 90, 5, 90)]
        drawn.sort(key=lambda r: (-r[2], first[r[2], r[1]]))
        y, s = np.array([r[1] for r in drawn]), np.array([r[2] for r in drawn])
        one, none = s[y == 1], s[y == 0]
        values["roc_auc"].append(np.mean((one[:, None] > none[None, :]) + 0.5 * (one[:, None] == none[None, :])))
        values["average_precision"].append((np.cumsum(y) / np.arange(1, 91))[y == 1].mean())
    for name in ("roc_auc", "average_precision", "or_per_score_sd"):
        assert near[name]["iterations_used"] == far[name]["iterations_used"] == 12
        for end, q in (("ci_low", 0.025), ("ci_high", 0.975)):
            assert near[name][end] == pytest.approx(far[name][end], abs=1e-7)
            if name in values:
                assert near[name][end] == pytest.approx(np.quantile(values[name], q), abs=1e-9)


def test_harmonic_sums():
    import numpy as np

    exact = np.cumsum(1.0 / np.arange(1, 200001))
    at = np.array([1, 2, 999, 1000, 1001, 5000, 200000])
    assert np.allclose(metrics._harmonic(at), exact[at - 1], rtol=1e-14) and metrics._harmonic(np.array([0]))[0] == 0
    cells = metrics.Cells(np.array([3.0, 2.0, 2.0]), np.array([1, 0, 1]), np.array([2, 1, 1]))
    assert cells.metrics(np.array([0, 5, 0])) == (None, None, None)
