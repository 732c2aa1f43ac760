"""Operators that need their input several times work it out once, and units fitted together are fitted as one by one."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from casewright.functions import distributions
from casewright.operators import association, incident, leads, profile, ranking, skew, sparse_regression, splits
from casewright.plans import genotype_queries, model_queries, study_queries
from casewright.sources import genotype_store
from casewright.sources.lens import Lens

SMALL = "/root/testdata/sf0.001"


def counted(spark, df):
    """``df`` and an accumulator of how many of its rows were worked out."""
    rows = spark.sparkContext.accumulator(0)

    def passed(frames):
        for frame in frames:
            rows.add(len(frame))
            yield frame

    return df.mapInPandas(passed, df.schema), rows


def test_benjamini_hochberg_reads_once(spark):
    df, rows = counted(spark, spark.range(50).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 5 > 0, F.col("id") / 50).alias("p")))
    got = {r.id: r.q for r in ranking.benjamini_hochberg(df, "p", "q", ["id"]).collect()}
    assert len(got) == 50 and got["49"] == 1.0 and got["5"] is None
    assert rows.value == 50


def test_units_fitted_together(spark):
    rng = np.random.default_rng(5)
    n = 4000
    base = np.column_stack([np.ones(n), rng.normal(size=n), rng.integers(0, 2, n)])
    y = (rng.random(n) < 0.3).astype(float)
    null = sparse_regression.null_fit_of(base, y)
    counts = np.array([12, 0, 25, 1, 40, 8])
    at = np.concatenate([rng.choice(n, c, replace=False) for c in counts])
    x = rng.integers(1, 3, len(at)).astype(float)
    kind, beta, se = sparse_regression.fit_units(null, counts, base[at], y[at], x)
    assert kind[1] == "open" and kind[3] == "separated" and "fitted" in kind
    ends = np.cumsum(counts)
    for i in np.flatnonzero(kind == "fitted"):
        own = slice(ends[i] - counts[i], ends[i])
        full = np.column_stack([base, np.zeros(n)])
        full[at[own], -1] = x[own]
        fitted = association.newton_logistic(full, y)
        assert association.wald(*fitted, 3)[:2] == pytest.approx((beta[i], se[i]), abs=1e-5)
        assert sparse_regression.fit_carriers(null, base[at[own]], y[at[own]], x[own])[1] == pytest.approx(beta[i], abs=1e-12)
    assert [(s.start, s.stop) for s in sparse_regression.unit_chunks(np.array([60_000, 60_000, 300_000, 5]))] == [(0, 1), (1, 2), (2, 3), (3, 4)]


def test_stratified_splits_read_once(spark):
    df, rows = counted(spark, spark.range(40).select(F.col("id").cast("string").alias("person_id"), (F.col("id") % 4 == 0).cast("int").alias("analysis_case")))
    got = splits.stratified_splits(df).collect()
    assert sum(r.analysis_split == "test" for r in got) == 8 and {r.cv_fold for r in got} == {None, 1, 2, 3, 4, 5}
    assert rows.value == 40


def test_qq_points_read_once(spark):
    df, rows = counted(spark, spark.range(1, 41).select(F.col("id").cast("string").alias("variant_id"), (F.col("id") / 40).alias("regression_p")))
    assert association.qq_points(df).count() == 40
    assert rows.value == 40


def test_lead_hits_read_once(spark):
    base = spark.createDataFrame([(f"v{i}", "1", i * 60, (i * 37 % 50 + 1) / 100) for i in range(50)], "variant_id string, chromosome string, position long, regression_p double")
    df, rows = counted(spark, base)
    assert leads.lead_hits(df, 100).count() > 5
    assert rows.value == 50


def test_carrier_tests_read_exposures_once(spark):
    people = spark.range(20).select(F.col("id").cast("string").alias("person_id"), (F.col("id") % 2).alias("outcome"))
    df, rows = counted(spark, spark.range(60).select((F.col("id") % 20).cast("string").alias("person_id"), F.concat(F.lit("v"), (F.col("id") % 6).cast("string")).alias("variant_id"), F.lit(1.0).alias("dosage")))
    assert association.carrier_tests(df, people, ["variant_id"]).count() == 6
    assert rows.value == 60


def test_gene_burden_reads_once(spark):
    people = spark.range(60).select(F.col("id").cast("string").alias("person_id"), (F.col("id") % 3 == 0).cast("int").alias("outcome"))
    masked = spark.range(90).select(
        F.lit("primary").alias("mask"), F.concat(F.lit("g"), (F.col("id") % 2).cast("string")).alias("gene"), (F.col("id") * 7 % 60).cast("string").alias("person_id"),
        F.concat(F.lit("v"), (F.col("id") % 9).cast("string")).alias("variant_id"), F.lit(1).alias("dosage"),
    )
    df, rows = counted(spark, masked)
    assert association.gene_burden(df, people, []).count() == 2
    assert rows.value == 90


def test_case_control_rows_stop_the_filter(spark):
    """The filter reads a table: it does not move below the columns that make the cohort up."""
    df, rows = counted(spark, spark.range(30).select(F.col("id").cast("string").alias("person_id"), (F.col("id") % 3).cast("int").alias("case_control_eligible"), F.lit(1).alias("other")))
    kept = incident.case_control_rows(df, "person_id")
    assert kept.columns == ["person_id"] and kept.count() == 10 and kept.count() == 10
    assert incident.case_control_rows(df).columns == ["person_id", "case_control_eligible", "other"]
    assert rows.value == 60


def test_exact_quantiles_read_once(spark):
    df, rows = counted(spark, spark.range(41).select((F.col("id") / 2).alias("v")))
    assert ranking.exact_quantiles(df, "v", {"m": 0.5}).first().m == 10.0
    assert rows.value == 41


def test_genotype_is_hashed(spark):
    """Calls are grouped without sorting them; the filter column is that of the text maximum."""
    lens = Lens(spark, SMALL)
    assert "SortAggregate" not in lens.genotype._jdf.queryExecution().executedPlan().toString()
    lines, orders = lens.table("lineitem"), lens.table("orders")
    text = lines.join(orders, lines.l_orderkey == orders.o_orderkey).groupBy("o_custkey", "l_partkey").agg(F.max("l_linestatus").alias("m"))
    kinds = lambda df, c: {(r[0], r["n"]) for r in df.groupBy(c.alias("ft")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert kinds(lens.genotype, F.col("ft")) == kinds(text, F.when(F.col("m") == "O", "PASS").otherwise("FAIL"))


def test_salted_lookup_reads_once(spark):
    df, rows = counted(spark, spark.range(40).select((F.col("id") % 4).alias("k"), "id"))
    assert skew.salted_lookup(df, spark.range(3).select(F.col("id").alias("k")), "k", "id").count() == 30
    assert rows.value == 40


@pytest.mark.parametrize("run", [genotype_queries._gwas, model_queries.ld_pruned], ids=["gwas", "ld_pruned"])
def test_calls_read_once(spark, monkeypatch, run):
    lens = Lens(spark, SMALL)
    df, rows = counted(spark, genotype_queries.called(lens).select("variant_id", "person_id", "n_alt"))
    for module in (genotype_queries, model_queries):
        monkeypatch.setattr(module, "called", lambda _: df)
    run(lens).count()
    assert rows.value == lens.genotype.count()


def test_logistic_reads_exposures_once(spark):
    people = spark.range(60).select(F.col("id").cast("string").alias("person_id"), (F.col("id") % 3 == 0).cast("int").alias("outcome"))
    df, rows = counted(spark, spark.range(50).select(F.concat(F.lit("v"), (F.col("id") % 2).cast("string")).alias("v"), F.col("id").cast("string").alias("person_id"), F.lit(1.0).alias("dosage")))
    assert association.logistic_per_unit(df, people, ["v"], [], broadcast_limit=0).count() == 2
    assert rows.value == 50


def test_biomarkers_read_once(spark):
    base = spark.range(30).select(F.col("id").cast("string").alias("person_id"), F.lit("serum sodium").alias("concept_name"), F.col("id").cast("double").alias("value"), F.lit(2).alias("days_before"), F.lit(1).cast("long").alias("n"))
    df, rows = counted(spark, base)
    got = profile.biomarker_availability(df, base, [("3d", 3), ("any_prior", None)], {"sodium": ("sodium",)}).collect()
    assert {(r.window, r.total_measurements, r.median_value) for r in got} == {("3d", 30, 14.5), ("any_prior", 30, 14.5)}
    assert rows.value == 30


def test_candidate_store_holds_the_read_columns(spark, monkeypatch):
    seen = []
    write = genotype_store.write_ranges
    monkeypatch.setattr(genotype_store, "write_ranges", lambda df, *rest: seen.append(df.columns) or write(df, *rest))
    study_queries.candidate_genotypes(Lens(spark, SMALL))
    assert seen == [["person_id", "variant_id", "contig", "position", "n_alt"]]


def test_equal_rows_worked_out_once():
    asked = []
    out = distributions._rows(lambda a, b: asked.append((a, b)) or a + b, pd.Series([1, 2, 1, 1]), pd.Series([5.0, math.nan, 5.0, 6.0]))
    assert out.tolist()[::2] == [6.0, 6.0] and out[3] == 7.0 and math.isnan(out[1])
    assert asked == [(1, 5.0), (1, 6.0)]


def test_comparison_sets_share_grouped_exposures(spark, monkeypatch):
    """Over blocks, exposures are worked out once for all sets, and without rare units no set fits its covariates alone."""
    rng = np.random.default_rng(4)
    people = pd.DataFrame([(s, f"p{i}", int(rng.random() < 0.4), float(rng.normal())) for s in "abc" for i in range(120)], columns=["comparison", "person_id", "outcome", "age"])
    calls = pd.DataFrame([(u, f"p{i}", 1.0) for u in ("g1", "g2") for i in range(120) if rng.random() < 0.4], columns=["unit", "person_id", "dosage"])
    df, rows = counted(spark, spark.createDataFrame(calls))
    monkeypatch.setattr(association, "null_fit_over", lambda *_: pytest.fail("no unit is rare"))
    panel = spark.createDataFrame([("g1",), ("g2",)], "unit string")
    run = lambda x, limit: association.logistic_per_unit(x, spark.createDataFrame(people), ["unit"], ["age"], panel=panel, comparison="comparison", broadcast_limit=limit)
    fields = ["comparison", "unit", "beta", "se", "regression_p", "n_samples"]
    got = sorted(map(tuple, run(df, 0).select(*fields).collect()))
    assert rows.value == len(calls) and len(got) == 6
    want = sorted(map(tuple, run(spark.createDataFrame(calls), 1 << 30).select(*fields).collect()))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    np.testing.assert_allclose([g[2:] for g in got], [w[2:] for w in want], rtol=1e-6)
