"""Vectorised tail probabilities for aggregated statistics.

Inputs are one row per tested unit (a variant, a gene, a table line), never raw records. Each public
function is an Arrow-batched pandas UDF factory around small numpy code.
"""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

_NORMAL = NormalDist()
_erfc = np.frompyfunc(math.erfc, 1, 1)


def normal_two_sided(z: np.ndarray) -> np.ndarray:
    return np.asarray(_erfc(np.abs(z) / math.sqrt(2.0)), dtype=float)


def chi2_1df_from_p(p: float) -> float:
    """Inverse survival function of χ² with one degree of freedom."""
    if p >= 1.0:
        return 0.0
    return _NORMAL.inv_cdf(p / 2.0) ** 2


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            c = 1.0 + num / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float, df: float) -> float:
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def t_critical(df: float, level: float = 0.975) -> float:
    """Upper quantile of Student's t by bisection on the two-sided tail."""
    tail = 2.0 * (1.0 - level)
    low, high = 0.0, 1.0
    while t_two_sided(high, df) > tail:
        high *= 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        low, high = (mid, high) if t_two_sided(mid, df) > tail else (low, mid)
    return (low + high) / 2.0


def chi2_survival(x: float, df: int) -> float:
    """Upper regularised incomplete gamma Q(df/2, x/2)."""
    if x <= 0:
        return 1.0
    a, z = df / 2.0, x / 2.0
    front = math.exp(a * math.log(z) - z - math.lgamma(a))
    if z < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= z / n
            total += term
        return 1.0 - front * total
    tiny = 1e-300
    b = z + 1 - a
    c, d = 1.0 / tiny, 1.0 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1.0 / (an * d + b or tiny)
        c = b + an / c or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def _extreme_share(log_weights: np.ndarray, at: int, midp: bool) -> float:
    """Share of the distribution no more likely than the observed point."""
    w = np.exp(log_weights - log_weights.max())
    observed = w[at]
    p = w[w <= observed * (1 + 1e-7)].sum() / w.sum()
    if midp:
        p -= 0.5 * observed / w.sum()
    return float(min(p, 1.0))


@lru_cache(maxsize=100_000)
def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Two-sided Fisher exact p of [[a, b], [c, d]] from hypergeometric weight ratios."""
    row, col, n = a + b, a + c, a + b + c + d
    low, high = max(0, row + col - n), min(row, col)
    if low == high:
        return 1.0
    k = np.arange(low, high, dtype=float)
    steps = np.log((row - k) * (col - k)) - np.log((k + 1) * (n - row - col + k + 1))
    return _extreme_share(np.concatenate([[0.0], np.cumsum(steps)]), a - low, False)


@lru_cache(maxsize=100_000)
def hardy_weinberg(hom_ref: int, het: int, hom_alt: int, midp: bool = False) -> float:
    """Exact Hardy–Weinberg p over all heterozygote counts of the same parity."""
    n = hom_ref + het + hom_alt
    if n == 0:
        return math.nan
    minor = 2 * min(hom_ref, hom_alt) + het
    hets = np.arange(minor % 2, minor + 1, 2, dtype=float)
    if len(hets) == 1:
        return 0.5 if midp else 1.0
    h = hets[:-1]
    rare = (minor - h) / 2
    common = n - h - rare
    steps = np.log(4.0 * rare * common) - np.log((h + 2) * (h + 1))
    at = (het - minor % 2) // 2
    return _extreme_share(np.concatenate([[0.0], np.cumsum(steps)]), at, midp)


def _rows(fn, *cols: pd.Series) -> pd.Series:
    """``fn`` of each row, nan where a value is missing; equal rows of a batch are worked out once."""
    found: dict[tuple, float] = {}
    out = np.empty(len(cols[0]))
    for i, row in enumerate(zip(*cols, strict=True)):
        value = found.get(row)
        if value is None:
            value = found[row] = math.nan if any(pd.isna(v) for v in row) else fn(*row)
        out[i] = value
    return pd.Series(out)


def _null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def two_sided_p(z: Column) -> Column:
    @F.pandas_udf("double")
    def p_of_z(v: pd.Series) -> pd.Series:
        return pd.Series(normal_two_sided(v.to_numpy(float)))

    return F.when(z.isNotNull(), _null(p_of_z(z)))


def fisher_p(a: Column, b: Column, c: Column, d: Column) -> Column:
    @F.pandas_udf("double")
    def p(w: pd.Series, x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:
        return _rows(lambda *t: fisher_two_sided(*(int(v) for v in t)), w, x, y, z)

    return _null(p(a.cast("long"), b.cast("long"), c.cast("long"), d.cast("long")))


def hwe_p(hom_ref: Column, het: Column, hom_alt: Column, midp: bool = True) -> Column:
    @F.pandas_udf("double")
    def p(x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:
        return _rows(lambda *t: hardy_weinberg(*(int(v) for v in t), midp), x, y, z)

    return _null(p(hom_ref.cast("long"), het.cast("long"), hom_alt.cast("long")))


def chi2_p(statistic: Column, df: Column) -> Column:
    @F.pandas_udf("double")
    def p(x: pd.Series, k: pd.Series) -> pd.Series:
        return _rows(lambda v, n: chi2_survival(v, int(n)) if n > 0 else math.nan, x, k)

    return _null(p(statistic.cast("double"), df.cast("double")))


def chi2_from_p(p: Column) -> Column:
    @F.pandas_udf("double")
    def stat(v: pd.Series) -> pd.Series:
        return _rows(chi2_1df_from_p, v)

    return _null(stat(p))


def student_p(t: Column, df: Column) -> Column:
    @F.pandas_udf("double")
    def p(x: pd.Series, k: pd.Series) -> pd.Series:
        return _rows(t_two_sided, x, k)

    return _null(p(t.cast("double"), df.cast("double")))


def student_critical(df: Column) -> Column:
    @F.pandas_udf("double")
    def q(k: pd.Series) -> pd.Series:
        return _rows(lambda v: t_critical(v) if v > 0 else math.nan, k)

    return _null(q(df.cast("double")))
