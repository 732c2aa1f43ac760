"""Prediction models: encoders learned on train rows, penalised logistic fits, predictions as columns."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from casewright.functions.scalars import lenient_double, normalised_category, sigmoid
from casewright.operators.metrics import model_metrics, youden_threshold
from casewright.operators.ranking import exact_quantiles
from casewright.session import cut_lineage

# Preferred category orders; the first observed category is the reference.
CATEGORY_ORDER = {
    "model_sex_category": ("female", "male", "other_or_unknown", "missing"),
    "model_ancestry_pred": ("eur", "afr", "amr", "eas", "sas", "mid", "other", "missing"),
}


class Encoder(Protocol):
    """One model column made of one source column."""

    feature: str
    source: str

    def column(self) -> Column: ...

    def described(self) -> tuple[str, str]:
        """What kind of column it is, and the level it is measured against."""


# Levels of one category that become one-hot columns.
MOST_LEVELS = 1000


@dataclass(frozen=True)
class Scaled:
    """A number, missing ones replaced by ``middle``, centred and in units of ``spread``."""

    feature: str
    source: str
    log: bool
    middle: float
    centre: float
    spread: float

    def column(self) -> Column:
        return (F.coalesce(_number(self.source, self.log), F.lit(self.middle)) - self.centre) / self.spread

    def described(self) -> tuple[str, str]:
        return "continuous", ""


@dataclass(frozen=True)
class Flag:
    """1 where the number is at least 1."""

    source: str

    @property
    def feature(self) -> str:
        return self.source

    def column(self) -> Column:
        return _flagged(self.source).cast("double")

    def described(self) -> tuple[str, str]:
        return "binary", ""


@dataclass(frozen=True)
class Level:
    """1 where the category is ``level``; ``against`` is the level left out."""

    source: str
    level: str
    against: str

    @property
    def feature(self) -> str:
        return f"{self.source}={self.level}"

    def column(self) -> Column:
        return (normalised_category(self.source) == self.level).cast("double")

    def described(self) -> tuple[str, str]:
        return "categorical", self.against


@dataclass(frozen=True)
class LogisticModel:
    encoders: tuple[Encoder, ...]
    intercept: float
    betas: tuple[float, ...]
    threshold: float
    penalty: float

    def probability(self) -> Column:
        """Plain column arithmetic, so scoring stays inside generated code."""
        terms = [e.column() * F.lit(b) for e, b in zip(self.encoders, self.betas, strict=True)]
        return sigmoid(reduce(add, terms, F.lit(self.intercept)))


def _number(source: str, log: bool) -> Column:
    v = lenient_double(source)
    return F.log1p(F.greatest(v, F.lit(0.0))) if log else v


def _flagged(source: str) -> Column:
    return F.coalesce(lenient_double(source), F.lit(0.0)) >= 1


def _by_key(key: str, values: dict) -> Column:
    """The value of a row's key: a literal for each of a handful of keys."""
    out = F.lit(None)
    for k, v in values.items():
        out = F.when(F.col(key) == k, v if isinstance(v, Column) else F.lit(v)).otherwise(out)
    return out


def _scaled(train: DataFrame, key: str, keys: Sequence, wanted: Sequence[tuple[str, str, str]], least: int) -> dict[object, list[Scaled]]:
    """For each key, the numbers with enough values and any spread. One pass for all medians, one for means and spreads after imputation."""
    values = {name: _number(source, how == "log1p") for source, name, how in wanted}
    if not values:
        return {k: [] for k in keys}
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), v.alias("value")) for n, v in values.items()])
    found = exact_quantiles(train.select(key, F.inline(pairs)), "value", {"middle": 0.5}, [key, "feature"])
    middle = {(r[key], r["feature"]): r["middle"] for r in found.collect()}
    filled = {n: F.coalesce(v, _by_key(key, {k: middle.get((k, n)) for k in keys}).cast("double")) for n, v in values.items()}
    statistics = [F.struct(F.count(v).alias("n"), F.avg(filled[n]).alias("centre"), F.stddev_pop(filled[n]).alias("spread")).alias(n) for n, v in values.items()]
    rows = {r[key]: r for r in train.groupBy(key).agg(*statistics).collect()}
    usable = lambda r: r["n"] >= max(least, 1) and r["spread"] is not None and math.isfinite(r["spread"]) and r["spread"] > 0
    return {
        k: [
            Scaled(name, source, how == "log1p", middle[k, name], rows[k][name]["centre"], rows[k][name]["spread"])
            for source, name, how in wanted
            if k in rows and usable(rows[k][name])
        ]
        for k in keys
    }


def _flags(train: DataFrame, key: str, keys: Sequence, wanted: Sequence[str]) -> dict[object, list[Flag]]:
    """For each key, the flags that both hold and fail somewhere."""
    if not wanted:
        return {k: [] for k in keys}
    found = train.groupBy(key).agg(*[F.struct(F.bool_or(_flagged(c)).alias("some"), F.bool_and(_flagged(c)).alias("all")).alias(c) for c in wanted])
    rows = {r[key]: r for r in found.collect()}
    return {k: [Flag(c) for c in wanted if k in rows and rows[k][c]["some"] and not rows[k][c]["all"]] for k in keys}


def _levels(train: DataFrame, key: str, keys: Sequence, source: str) -> dict[object, list[Level]]:
    """For each key, a column for each level but the first. Raises above ``MOST_LEVELS`` levels, before they are gathered."""
    found = train.select(key, normalised_category(source).alias("level")).distinct()
    seen = {k: set() for k in keys}
    for r in found.limit((MOST_LEVELS + 1) * len(seen)).collect():
        seen[r[key]].add(r["level"])
    out = {}
    for k, levels in seen.items():
        if len(levels) > MOST_LEVELS:
            raise ValueError(f"{source} has more than {MOST_LEVELS} levels, too many for one-hot columns")
        first = [v for v in CATEGORY_ORDER.get(source, ()) if v in levels]
        ordered = [*first, *sorted(levels.difference(first))]
        out[k] = [Level(source, v, ordered[0]) for v in ordered[1:]]
    return out


def fit_encoders(train: DataFrame, continuous: Sequence[tuple[str, str, str]], **wanted) -> tuple[Encoder, ...]:
    """Encoders learned from train rows only; absent, under-observed and constant columns have none. See ``encoders_by``."""
    return encoders_by(train.withColumn("_only", F.lit(0)), "_only", [0], continuous, **wanted)[0]


def encoders_by(
    train: DataFrame,
    key: str,
    keys: Sequence,
    continuous: Sequence[tuple[str, str, str]],
    binary: Sequence[str] = (),
    categorical: Sequence[str] = ("model_sex_category", "model_ancestry_pred"),
    min_observed: int = 1,
) -> dict[object, tuple[Encoder, ...]]:
    """Encoders for each of ``keys``, a handful, learned from its rows, in as many jobs as for one.

    ``continuous`` lists (source column, feature name, "identity" or "log1p"). What reaches the driver is one row of
    statistics for each kind and key, and the category levels.
    """
    have = set(train.columns)
    parts = [_scaled(train, key, keys, [c for c in continuous if c[0] in have], min_observed), _flags(train, key, keys, [c for c in binary if c in have])]
    parts += [_levels(train, key, keys, c) for c in categorical if c in have]
    return {k: tuple(e for p in parts for e in p[k]) for k in keys}


def ridge_fits(design: DataFrame, key: str, penalty: float, most_steps: int = 60, small: float = 1e-10) -> dict[object, tuple[float, np.ndarray]]:
    """(intercept, betas) for each key of ``design (key, label, x array<double>)``: Σ log-loss + ½·penalty·‖β‖², intercept free.

    Newton's method for all keys at once: a step is one scan, whose sums are made in the tasks and added up by key.
    """
    first = design.groupBy(key).agg(F.max(F.size("x")).alias("p")).collect()
    beta = {r[key]: np.zeros(r["p"] + 1) for r in first}
    open_ = set(beta)
    kind = design.schema[key].dataType.simpleString()

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k, rows in frame.groupby("key"):
                x = np.column_stack([np.ones(len(rows)), np.vstack(rows["x"].to_numpy())])
                p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta[k], -40, 40)))
                flat = np.concatenate([x.T @ (rows["label"].to_numpy(float) - p), (x.T @ (x * (p * (1 - p))[:, None])).ravel()])
                yield pd.DataFrame({"key": k, "place": np.arange(len(flat)), "value": flat})

    for _ in range(most_steps):
        rows = design.filter(F.col(key).isin(*open_)).select(F.col(key).alias("key"), "label", "x")
        added = rows.mapInPandas(sums, f"key {kind}, place int, value double").groupBy("key", "place").agg(F.sum("value").alias("value"))
        for k, flat in added.toPandas().sort_values("place").groupby("key")["value"]:  # (p + 1) * (p + 2) numbers a key
            flat, n = flat.to_numpy(), len(beta[k])
            pull = np.array([0.0, *[penalty] * (n - 1)])
            step = np.linalg.solve(flat[n:].reshape(n, n) + np.diag(pull), flat[:n] - pull * beta[k])
            beta[k] = beta[k] + step
            if np.abs(step).max() < small:
                open_.discard(k)
        if not open_:
            return {k: (float(b[0]), b[1:]) for k, b in beta.items()}
    raise ValueError(f"no convergence for {sorted(open_)}")


def fit_logistic(train: DataFrame, encoders: Sequence[Encoder], outcome: str, penalty: float = 1.0) -> LogisticModel:
    """Σ log-loss + ½·penalty·‖β‖², intercept free. MLlib minimises the mean, hence regParam = penalty / n."""
    if not encoders:
        raise ValueError("no usable model features")
    names = [f"_f{i}" for i in range(len(encoders))]
    design = cut_lineage(
        train.select(F.col(outcome).cast("double").alias("label"), *[e.column().alias(n) for e, n in zip(encoders, names, strict=True)])
    )
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(design).select("label", "features")
    estimator = LogisticRegression(
        regParam=penalty / design.count(), elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-10
    )
    fitted = estimator.fit(vectors)
    return LogisticModel(tuple(encoders), float(fitted.intercept), tuple(float(b) for b in fitted.coefficients), 0.5, penalty)


def scored_frame(frame: DataFrame, model: LogisticModel, outcome: str) -> DataFrame:
    return frame.select("person_id", F.col(outcome).cast("int").alias("y"), model.probability().alias("score"))


def fit_model(
    train: DataFrame, outcome: str, features: dict, penalty: float = 1.0
) -> LogisticModel:
    """Encoders, fit and the Youden threshold on the training probabilities."""
    model = fit_logistic(train, fit_encoders(train, **features), outcome, penalty)
    best = youden_threshold(scored_frame(train, model, outcome)).first()
    return LogisticModel(model.encoders, model.intercept, model.betas, float(best["threshold"]) if best else 0.5, penalty)


def coefficient_table(spark, model: LogisticModel) -> DataFrame:
    rows = [("intercept", "", "intercept", "", model.intercept)]
    rows += [(e.feature, e.source, *e.described(), b) for e, b in zip(model.encoders, model.betas, strict=True)]
    table = spark.createDataFrame(rows, "feature string, source_column string, kind string, reference string, beta double")
    return table.withColumn("odds_ratio", F.exp("beta"))


def top_coefficients(coefficients: DataFrame, n: int = 20) -> DataFrame:
    return coefficients.filter("feature <> 'intercept'").orderBy(F.desc(F.abs("beta")), "feature").limit(n)


def cv_metrics(train: DataFrame, outcome: str, features: dict, penalty: float = 1.0, fold: str = "cv_fold") -> DataFrame | None:
    """Metrics of each held-out fold; folds lacking a class on either side are skipped.

    All folds are done at once, each row standing in every fit but its own fold's: encoders, Newton's steps, thresholds
    and metrics take as many jobs as for one fold. At most a handful of folds.
    """
    counts = train.filter(F.col(fold).isNotNull()).groupBy(fold, F.col(outcome).cast("int").alias("y")).count().collect()
    folds = sorted({r[fold] for r in counts})
    cell = {(r[fold], r["y"]): r["count"] for r in counts}
    held = lambda k: all(cell.get((k, y), 0) for y in (0, 1))
    rest = lambda k: all(sum(cell.get((j, y), 0) for j in folds if j != k) for y in (0, 1))
    usable = [k for k in folds if held(k) and rest(k)]
    if not usable:
        return None
    known = train.filter(F.col(fold).isNotNull())
    fitted_on = cut_lineage(known.withColumn("_held", F.explode(F.array(*map(F.lit, usable)))).filter(F.col(fold) != F.col("_held")))
    encoders = encoders_by(fitted_on, "_held", usable, **features)
    if not all(encoders.values()):
        raise ValueError("no usable model features")
    vector = _by_key("_held", {k: F.array(*[e.column() for e in found]) for k, found in encoders.items()})
    design = cut_lineage(fitted_on.select("_held", F.col(outcome).cast("double").alias("label"), vector.alias("x")))
    fits = ridge_fits(design, "_held", penalty)
    models = {k: LogisticModel(encoders[k], fits[k][0], tuple(map(float, fits[k][1])), 0.5, penalty) for k in usable}
    score = lambda key: _by_key(key, {k: m.probability() for k, m in models.items()}).cast("double").alias("score")
    y = F.col(outcome).cast("int").alias("y")
    best = youden_threshold(fitted_on.select("_held", "person_id", y, score("_held")), ["_held"])
    cuts = {r["_held"]: float(r["threshold"]) for r in best.collect()}
    scored = known.filter(F.col(fold).isin(*usable)).select(F.col(fold).alias("fold"), "person_id", y, score(fold))
    return model_metrics(scored, _by_key("fold", cuts).cast("double"), ["fold"])


def run_model(
    model_input: DataFrame, outcome: str, features: dict, eligibility: str | None = None, penalty: float = 1.0
) -> dict[str, DataFrame | LogisticModel]:
    """Fit on train, evaluate on train and test, predict both."""
    rows = model_input.filter(F.col(outcome).cast("int").isin(0, 1))
    if eligibility:
        rows = rows.filter(F.coalesce(F.col(eligibility).cast("int"), F.lit(0)) == 1)
    rows = cut_lineage(rows)
    per = {(r["analysis_split"], r["y"]): r["count"] for r in rows.groupBy("analysis_split", F.col(outcome).cast("int").alias("y")).count().collect()}
    if not all(per.get((s, y)) for s in ("train", "test") for y in (0, 1)):
        raise ValueError("train and test both need cases and controls")
    train = rows.filter("analysis_split = 'train'")
    model = fit_model(train, outcome, features, penalty)
    predictions = rows.filter("analysis_split in ('train', 'test')").withColumn("predicted_probability", model.probability())
    predictions = cut_lineage(
        predictions.withColumn("predicted_label", (F.col("predicted_probability") >= model.threshold).cast("int"))
    )
    scored = predictions.select(
        F.col("analysis_split").alias("evaluation_set"), "person_id", F.col(outcome).cast("int").alias("y"),
        F.col("predicted_probability").alias("score"),
    )
    return {
        "model": model,
        "metrics": model_metrics(scored, model.threshold, ["evaluation_set"]),
        "coefficients": coefficient_table(rows.sparkSession, model),
        "predictions": predictions,
    }


def heldout_comparison(predictions: DataFrame, scores: DataFrame) -> DataFrame:
    """Rows of people with both a model probability and a score, one model label each, per threshold."""
    keys = ["person_id", "analysis_case"]
    both = predictions.select(*keys, F.col("predicted_probability").alias("_p")).join(
        scores.select(*keys, "threshold_label", F.col("prs_score").alias("_s")), keys
    ).filter(F.col("_p").isNotNull() & F.col("_s").isNotNull())
    pair = F.array(
        F.struct(F.lit("clinical_only").alias("model"), F.col("_p").alias("score")),
        F.struct(F.lit("prs_only").alias("model"), F.col("_s").alias("score")),
    )
    return both.select("person_id", "threshold_label", F.col("analysis_case").cast("int").alias("y"), F.inline(pair))
