"""Scalar column functions: lenient casts, category clean-up, date arithmetic, keys and formats.

Spark 4 runs in ANSI mode, so every coercion that means "bad input is missing" goes through ``try_*``.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

# Text labels that mean "missing".
MISSING_LABELS = (
    "",
    "nan",
    "none",
    "null",
    "na",
    "n/a",
    "missing",
    "no matching concept",
    "unknown",
    "skip",
    "pmi: skip",
    "prefer not to answer",
    "pmi: prefer not to answer",
)
FEMALE_LABELS = ("female", "f", "2")
MALE_LABELS = ("male", "m", "1")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """Lower-cased, trimmed text."""
    return F.lower(F.trim(_col(c).cast("string")))


def lenient_double(c: Column | str) -> Column:
    """Number or NULL; NaN becomes NULL so that it can never reach an aggregate."""
    v = _col(c).try_cast("double")
    return F.when(~F.isnan(v), v)


def lenient_date(c: Column | str) -> Column:
    """Date or NULL for text, date and timestamp input."""
    return _col(c).try_cast("date")


def sex_flag(c: Column | str) -> Column:
    """1.0 female, 0.0 male, NULL otherwise."""
    v = clean(c)
    return F.when(v.isin(*FEMALE_LABELS), 1.0).when(v.isin(*MALE_LABELS), 0.0)


def is_missing_label(c: Column | str) -> Column:
    v = clean(c)
    return v.isNull() | v.isin(*MISSING_LABELS)


def sex_category(c: Column | str) -> Column:
    v = clean(c)
    return (
        F.when(is_missing_label(c), "missing")
        .when(v.isin(*FEMALE_LABELS), "female")
        .when(v.isin(*MALE_LABELS), "male")
        .otherwise("other_or_unknown")
    )


def normalised_category(c: Column | str) -> Column:
    """Lower/trim with every missing label folded to ``missing``."""
    return F.when(is_missing_label(c), "missing").otherwise(clean(c))


def category_or_missing(c: Column | str) -> Column:
    """Trimmed text in its own case, missing labels folded to ``missing``."""
    return F.when(is_missing_label(c), "missing").otherwise(F.trim(_col(c).cast("string")))


def truthy(c: Column | str) -> Column:
    """Flag test over mixed numeric and text cells; NULL is False."""
    v = clean(c)
    number = v.try_cast("double")
    return F.coalesce((number != 0) & ~F.isnan(number), v.isin("true", "t", "yes", "y"), F.lit(False))


def vector_elements(c: Column | str, count: int) -> list[Column]:
    """``"[a, b, …]"`` or ``"a,b,…"`` as ``count`` doubles; short or bad elements are NULL."""
    parts = F.split(F.regexp_replace(_col(c), r"[\[\]]", ""), ",")
    return [lenient_double(F.trim(F.get(parts, F.lit(i)))) for i in range(count)]


def years_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier) / F.lit(365.25)


def age_at(when: Column, year_of_birth: Column, birth_date: Column, fallback: Column) -> Column:
    """Age at a date: year of birth wins over birth date, which wins over the recorded age."""
    return F.coalesce(
        F.year(when).cast("double") - year_of_birth,
        years_between(when, birth_date),
        fallback,
    )


def observation_midpoint(start: Column, end: Column) -> Column:
    """Midpoint of two dates in days since the epoch, half days kept."""
    epoch = F.lit("1970-01-01").cast("date")
    return (F.datediff(start, epoch) + F.datediff(end, epoch)) / F.lit(2.0)


def variant_key(contig: Column | str, pos: Column | str, ref: Column | str, alt: Column | str, sep: str = "-") -> Column:
    return F.concat_ws(
        sep,
        F.regexp_replace(_col(contig).cast("string"), "^chr", ""),
        _col(pos).cast("string"),
        _col(ref),
        _col(alt),
    )


def interval_text(contig: Column, start: Column, end: Column) -> Column:
    return F.concat(contig, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"))


def hash_hex(c: Column | str) -> Column:
    """First 16 hex digits of SHA-256; text order equals the numeric order of the score."""
    return F.substring(F.sha2(_col(c).cast("string"), 256), 1, 16)


def hash_score(c: Column | str) -> Column:
    """The same digits as a number in [0, 1]."""
    digits = F.conv(hash_hex(c), 16, 10).cast("decimal(20,0)")
    return digits.cast("double") / F.lit(float(16**16 - 1))


def neg_log10(p: Column | str) -> Column:
    return -F.log10(F.greatest(_col(p), F.lit(1e-300)))


def logit(p: Column | str, eps: float = 1e-6) -> Column:
    q = F.least(F.greatest(_col(p), F.lit(eps)), F.lit(1 - eps))
    return F.log(q / (F.lit(1.0) - q))


def sigmoid(z: Column | str, bound: float = 40.0) -> Column:
    v = F.least(F.greatest(_col(z), F.lit(-bound)), F.lit(bound))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-v))


# Display formats -------------------------------------------------------------------------------

def fmt_count_pct(n: Column, total: Column) -> Column:
    return F.when(total > 0, F.format_string("%d (%.1f%%)", n.cast("long"), n * 100.0 / F.nullif(total, F.lit(0)))).otherwise("")


def fmt_mean_sd(mean: Column, sd: Column) -> Column:
    return F.when(mean.isNull(), "").otherwise(F.format_string("%.1f (%.1f)", mean, F.coalesce(sd, F.lit(0.0))))


def fmt_p(p: Column) -> Column:
    return F.when(p.isNull(), "").when(p < 1e-4, F.format_string("%.2e", p)).otherwise(F.format_string("%.4f", p))


def fmt_smd(v: Column) -> Column:
    return F.when(v.isNull(), "").otherwise(F.format_string("%.3f", v))


def fmt_effect(v: Column) -> Column:
    big = (F.abs(v) >= 100) | ((F.abs(v) < 0.01) & (v != 0))
    return F.when(v.isNull(), "").when(big, F.format_string("%.2e", v)).otherwise(F.format_string("%.3f", v))


def fmt_ci(low: Column, high: Column) -> Column:
    return F.when(low.isNull() | high.isNull(), "").otherwise(F.concat(fmt_effect(low), F.lit(", "), fmt_effect(high)))


# Parameter helpers (plain Python on small parameter values) --------------------------------------

def slugify(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", text.lower()).strip("_")


def parameter_hash(parameters: object) -> str:
    payload = json.dumps(parameters, sort_keys=True, default=str)
    return hashlib.sha256(payload.encode("utf-8")).hexdigest()[:16]


def threshold_label(value: float) -> str:
    return "p" + f"{value:g}".replace(".", "_").replace("+", "")


def threshold_from_label(label: str) -> float:
    return float(label.removeprefix("p").replace("_", "."))


def parse_thresholds(text: str | Iterable[float]) -> list[float]:
    raw = text.split(",") if isinstance(text, str) else list(text)
    values = [float(v) for v in raw if str(v).strip()]
    if not values or any(not 0 <= v <= 1 for v in values):
        raise ValueError("thresholds must lie in [0, 1]")
    return sorted(set(values))


def parse_windows(text: str | Sequence[str]) -> list[tuple[str, int | None]]:
    """``"365,1095,all"`` → ordered distinct (label, days) pairs; ``all`` becomes the unbounded ``any_prior``."""
    raw = text.split(",") if isinstance(text, str) else list(text)
    out: dict[str, int | None] = {}
    for item in (str(v).strip().lower() for v in raw):
        if not item:
            continue
        if item == "all":
            out.setdefault("any_prior", None)
            continue
        days = int(item.removesuffix("d"))
        if days <= 0:
            raise ValueError(f"window must be positive: {item}")
        out.setdefault(f"{days}d", days)
    if not out:
        raise ValueError("no window given")
    return list(out.items())


def autosomes(values: Iterable[str | int]) -> list[str]:
    """``chr`` stripped, order kept, duplicates dropped; anything outside 1–22 is an error."""
    out = list(dict.fromkeys(str(v).strip().removeprefix("chr") for v in values))
    bad = [v for v in out if not v.isdigit() or not 1 <= int(v) <= 22]
    if bad or not out:
        raise ValueError(f"not autosomes: {bad}")
    return out
