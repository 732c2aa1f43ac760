import json
import random

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from casewright.operators import cohort, splits
from casewright.plans import drivers


def test_case_control_bundle(spark, tmp_path):
    person, periods, conditions, measurements = fx.case_control(spark)
    ancestry = cohort.ancestry_frame(
        spark.createDataFrame([(p, "north" if p in fx.FEMALE else "south", f"[0.{i}, bad]") for i, p in enumerate(fx.IDS, start=1)], "research_id string, ancestry_pred string, pca string"),
        "research_id", "ancestry_pred", ["PC1", "PC2", "PC3"], "pca",
    )
    out = drivers.case_control(person, periods, conditions, measurements, fx.RULES, fx.MATCH, ancestry)
    steps = {r.step: r.n for r in out["consort"].collect()}
    assert steps["broad_cases"] == 4 and steps["definite_cases"] == 3 and steps["built_rows"] == 14
    matched = out["matched"].collect()
    assert steps["matched_rows"] == len(matched) and steps["matched_cases"] >= 1
    by_group = {}
    for r in matched:
        by_group.setdefault(r.match_group_id, []).append(r)
    for rows in by_group.values():
        assert sorted(r.match_rank for r in rows) == list(range(len(rows)))
        assert len({r.index_date for r in rows}) == 1 and len({r.is_female for r in rows}) == 1
    assert out["cohort"].filter("person_id = 'a'").first().pc1 == 0.1
    paths = drivers.write_outputs(spark, {k: out[k] for k in ("cohort_qc", "consort", "table1", "critical_illness", "prior_timing", "missingness", "model_input")}, str(tmp_path), {"ratio": 2})
    assert spark.read.parquet(paths["consort"]).count() == 9


def test_incident_bundle(spark):
    genotyped = spark.createDataFrame([(p,) for p in [*fx.TARGETS][:9]], "IID string")
    out = drivers.incident_study(*fx.incident(spark), fx.INCIDENT, genotyped=genotyped)
    assert {r.step: r.n for r in out["consort"].collect()}["source_rows"] == "32"
    assert {r.metric: r.n for r in out["genotyped_overlap"].collect()}["genotype_sample_ids"] == 9
    assert {r.analysis_split for r in out["model_input"].collect()} == {"train", "test"}
    assert out["table1"].count() > 0 and out["missingness"].count() > 0


def test_dense_gwas_bundle(spark):
    rnd = random.Random(1)
    people = [(f"p{i}", int(rnd.random() < 0.4), rnd.gauss(0, 1), 1.0) for i in range(120)]
    calls = [(f"v{v}", p[0], rnd.choice([0, 0, 1, 2])) for v in range(5) for p in people if rnd.random() > 0.02]
    variants = [(f"v{v}", "1", 1000 * v, ["A", "AT" if v == 4 else "G"]) for v in range(5)]
    out = drivers.variant_gwas(
        spark.createDataFrame(calls, "variant_id string, person_id string, n_alt int"),
        spark.createDataFrame(variants, "variant_id string, chromosome string, position long, alleles array<string>"),
        spark.createDataFrame(people, "person_id string, analysis_case int, age double, const double"),
        ["age", "const"], dense=True, window_bp=1500, min_call_rate=0.5, min_hwe_p=0.0,
    )
    results = {r.variant_id: r for r in out["results"].collect()}
    assert set(results) == {"v0", "v1", "v2", "v3"} and all(r.n_samples == 120 and r.covariates == "age" for r in results.values())
    assert {r.covariate: r.status for r in out["covariates"].collect()} == {"age": "kept", "const": "dropped"}
    best = min(results.values(), key=lambda r: r.regression_p)
    assert best.variant_id in {r.variant_id for r in out["lead_hits"].collect()}
    assert [r.rows_after for r in sorted(out["qc_funnel"].collect(), key=lambda r: r.step)][:2] == [5, 4]


def test_score_bundles(spark):
    rnd = random.Random(7)
    rows = [(f"p{i:03d}", "test" if i % 3 == 0 else "train", int(rnd.random() < 0.4), rnd.gauss(0, 1), rnd.random(), rnd.choice("ab")) for i in range(150)]
    df = spark.createDataFrame(rows, "person_id string, analysis_split string, analysis_case int, prs_score double, probability double, site string")
    out = drivers.score_diagnostics(df, ["site"], iterations=5)
    assert out["deciles"].count() == 10 and out["stratified"].count() == 2 and out["probability"].count() == 2
    assert sum(r.n for r in out["calibration"].filter("model = 'raw'").collect()) == 50


def test_incident_model_bundle(spark):
    rnd = random.Random(3)
    names = "person_id string, analysis_case int, case_control_eligible int, age_at_baseline double, prior_diabetes int, sex_category string, ancestry_pred string"
    rows = [(f"p{i:03d}", int(rnd.random() < 0.4), int(i % 10 > 0), rnd.gauss(50, 9), rnd.randrange(2), rnd.choice(["male", " ", None]), rnd.choice([" North", "south", ""])) for i in range(240)]
    model_input = splits.incident_model_input(spark.createDataFrame(rows, names))
    held = model_input.collect()
    assert len(held) == sum(r[2] for r in rows)
    assert {r.model_sex_category for r in held} == {"male", "missing"} and {r.model_ancestry_pred for r in held} == {"north", "south", "missing"}
    out = drivers.incident_model(model_input, dict(continuous=[("age_at_baseline", "age_per_sd", "identity")], binary=["prior_diabetes"]))
    assert {r.evaluation_set for r in out["metrics"].collect()} == {"train", "test"}
    deciles = sorted(out["risk_deciles"].collect(), key=lambda r: r.decile)
    test = [r for r in held if r.analysis_split == "test"]
    assert sum(r.n for r in deciles) == len(test) and max(r.n for r in deciles) - min(r.n for r in deciles) <= 1
    means = [r.mean_predicted_probability for r in deciles]
    assert means == sorted(means) and "predicted_label" in out["predictions"].columns and out["cv_metrics"].count() > 0


def test_clinical_score_bundle(spark):
    rnd = random.Random(4)
    people = [(f"p{i:03d}", i % 2, "test" if i % 4 > 1 else "train", i % 5, rnd.gauss(40, 5)) for i in range(160)]
    table = [(p[0], label, None if i % 10 == 9 else p[1] * 0.8 + rnd.gauss(0, 1)) for i, p in enumerate(people) for label in ("p1", "p0_5")]
    model_input = spark.createDataFrame(people, "person_id string, analysis_case int, analysis_split string, cv_fold int, age double")
    features = dict(continuous=[("age", "age_per_sd", "identity")], binary=[])
    table = spark.createDataFrame(table, "person_id string, threshold_label string, prs_score double")
    out = drivers.clinical_score_model(model_input, table, features, "p1", None)
    assert out["predictions"].count() == 144 and {r.threshold_label for r in out["metrics"].collect()} == {"p1"}
    beta = {r.feature: r.beta for r in out["coefficients"].collect()}
    assert beta["prs_score_per_sd"] > 0 and "age_per_sd" in beta
    with pytest.raises(ValueError, match="no variance"):
        drivers.clinical_score_model(model_input, table.withColumn("prs_score", F.lit(1.0)), features, "p1", None)


def test_association_study_in_one_run(spark, tmp_path):
    person, periods, conditions, measurements = fx.case_control(spark)
    ancestry = cohort.ancestry_frame(
        spark.createDataFrame([(p, "north", f"[0.{i}, 0]") for i, p in enumerate(fx.IDS, start=1)], "research_id string, ancestry_pred string, pca string"),
        "research_id", "ancestry_pred", ["PC1", "PC2", "PC3"], "pca",
    )
    tables = dict(person=person, periods=periods, conditions=conditions, measurements=measurements, ancestry=ancestry)
    rnd = random.Random(5)
    calls = spark.createDataFrame([(f"v{v}", p, rnd.choice([1, 1, 2])) for v in range(4) for p in fx.IDS if rnd.random() < 0.6], "variant_id string, person_id string, n_alt int")
    variants = spark.createDataFrame([(f"v{v}", "1", 1000 * v, ["A", "G"]) for v in range(4)], "variant_id string, chromosome string, position long, alleles array<string>")
    annotation = spark.createDataFrame(
        [(f"v{v}", f"g{v % 2}", "Pathogenic" if v else "Benign", "missense", 0.9, 0.001) for v in range(4)],
        "variant_id string, gene string, clinvar_significance string, consequence string, revel double, max_af double",
    )
    panel = spark.createDataFrame([("v1", "carrier_vs_noncarrier"), ("v2", "hom_alt_vs_rest"), ("v9", "carrier_vs_noncarrier")], "variant_id string, exact_test_model string")
    run = lambda folder, **more: drivers.association_study(
        tables, fx.RULES, fx.MATCH, calls, variants, annotation, panel, ["age_at_index"], ["pathogenic"], ["stop"], f"{tmp_path}/{folder}", **more
    )
    paths = run("all", min_maf=0.0, min_mac=1, min_call_rate=0.0, min_hwe_p=0.0)
    manifest = json.loads(spark.read.text(f"{tmp_path}/all/manifest.json").first()[0])
    assert set(manifest["counts"]) == set(paths) >= {"cohort", "matched", "qc", "prior_association", "variant_association", "gene_association", "gene_burden", "results", "lead_hits"}
    assert manifest["counts"]["cohort"] == 14
    prior = spark.read.parquet(paths["prior_association"]).collect()
    sets = {r.comparison for r in prior}
    assert {"broad", "definite"} <= sets and len(prior) == 3 * len(sets) and {r.variant_id for r in prior} == {"v1", "v2", "v9"}
    assert {r.gene for r in spark.read.parquet(paths["gene_burden"]).collect()} == {"g0", "g1"}
    assert set(run("some", stages=("burden",))) == {"cohort", "matched", "qc", "gene_burden"}
    with pytest.raises(ValueError, match="unknown stages"):
        run("none", stages=("other",))
