"""End-to-end runs: compose the operators and write their tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright.functions.scalars import parse_windows
from casewright.operators import (
    anchors,
    association,
    cohort,
    describe,
    genotypes,
    incident,
    leads,
    matching,
    metrics,
    models,
    profile,
    samples,
    scores,
    splits,
)
from casewright.rules import IncidentRules, Matching, PhenotypeRules
from casewright.session import cut_lineage
from casewright.sources import genotype_store
from casewright.sources.tables import ASSOCIATION_ORDER, COHORT_ORDER, write_manifest, write_table


# Outputs that are written in order.
ORDERED = {
    "cohort": COHORT_ORDER,
    "variant_association": (*ASSOCIATION_ORDER, "variant_id"),
    "gene_association": (*ASSOCIATION_ORDER, "gene"),
    "prior_association": (*ASSOCIATION_ORDER, "variant_id"),
    "gene_burden": ("regression_p", "mask", "gene"),
    "results": ("regression_p", "variant_id"),
}


def write_outputs(spark: SparkSession, tables: dict[str, DataFrame], folder: str, config: dict) -> dict[str, str]:
    paths = {name: write_table(df, f"{folder}/{name}.parquet", order=ORDERED.get(name, ())) for name, df in tables.items()}
    counts = {name: spark.read.parquet(path).count() for name, path in paths.items()}
    write_manifest(spark, config, paths, counts, f"{folder}/manifest.json")
    return paths


def case_control(
    person: DataFrame, periods: DataFrame, conditions: DataFrame, measurements: DataFrame, rules: PhenotypeRules,
    match: Matching, ancestry: DataFrame | None = None, universe: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Cohort → matching → re-anchored flags → splits → eligibility → the descriptive bundle."""
    built = cut_lineage(cohort.build_cohort(person, periods, conditions, measurements, rules, ancestry))
    pool = built if universe is None else samples.restrict_to_ids(built, universe)
    names = rules.cofactor_names
    flags = [c for n in names for c in (n, *[f"{p}_{n}" for p in anchors.ANCHORED_PREFIXES])]
    # the matched rows are judged again, now against the inherited index dates
    pairs = matching.match_case_controls(pool, match).drop(*[c for c in flags if c not in names])
    events = cohort.cofactor_events(conditions, rules)
    matched = cut_lineage(splits.eligibility_flags(splits.group_splits(anchors.anchored_flags(pairs, events, names))))
    role = F.when(F.col("analysis_case") == 1, "matched_cases").otherwise("matched_controls")
    groups = F.array(F.lit("all_matched"), role, F.col("analysis_split"))
    critical = built.filter("broad_case = 1").select("person_id", *flags, "definite_case", F.lit("built_broad_cases").alias("group")).unionByName(
        matched.select("person_id", *flags, "definite_case", role.alias("group"))
    )
    table1 = lambda by: describe.format_two_group(
        describe.two_group_table(matched, "analysis_case", ["age_at_index"], flags, ["sex_category", "ancestry_pred"], by=by), by
    )
    either = {f"{p}_sepsis_or_renal_injury": (f"{p}_sepsis", f"{p}_renal_injury") for p in ("remote_preindex", "near_preindex", "preindex", "periindex")}
    return {
        "cohort": built,
        "cohort_qc": cohort.cohort_qc(built),
        "matched": matched,
        "matching_qc": matching.matching_qc(matched),
        "consort": describe.consort(built, matched),
        "table1": table1([]),
        "table1_by_split": table1(["analysis_split"]),
        "split_summary": splits.split_summary(matched),
        "eligibility_summary": splits.eligibility_summary(matched),
        "missingness": describe.missingness(matched, splits.MODEL_COLUMNS, groups),
        "critical_illness": describe.flag_summary(critical, ["definite_case", *flags], either),
        "prior_timing": anchors.prior_timing_summary(matched.filter("analysis_case = 1"), events, names),
        "timing_histogram": anchors.timing_histogram(matched, events, names),
        "model_input": splits.model_input(matched),
    }


def incident_study(
    person: DataFrame, periods: DataFrame, conditions: DataFrame, measurements: DataFrame, rules: IncidentRules,
    ancestry: DataFrame | None = None, genotyped: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Incident cohort, feasibility, splits and the suppressed characterisation tables."""
    built = cut_lineage(incident.build_incident_cohort(person, periods, conditions, measurements, rules, ancestry))
    rows = cut_lineage(splits.incident_model_input(built))
    labs = [f"prebaseline_{lab.label}_{s}" for lab in rules.labs for s in ("last", "max")]
    binary = [*rules.history, "ck_tested_prebaseline", "ck_tested_during_horizon"]
    columns = ["age_at_baseline", "sex_category", "ancestry_pred", *labs, *binary]
    out = {
        "incident_cohort": built,
        "consort": describe.suppress_small_counts(incident.incident_consort(built)),
        "feasibility": incident.feasibility_summary(built),
        "split_summary": describe.suppress_small_counts(splits.split_summary(rows)),
        "table1": describe.format_two_group(
            describe.two_group_table(
                rows, "analysis_case", ["age_at_baseline", *labs], binary, ["sex_category", "ancestry_pred"],
                by=["analysis_split"], null_as_zero=True,
            ),
            ["analysis_split"],
        ),
        "missingness": describe.suppress_small_counts(describe.missingness(rows, columns, F.array(F.lit("all")))),
        "model_input": rows,
    }
    if genotyped is not None:
        out["genotyped_overlap"] = incident.genotyped_overlap(incident.feasibility_ids(built), genotyped)
    return out


def preindex_profile(built: DataFrame, conditions: DataFrame, measurements: DataFrame, windows: str = "365,1095,all", top_n: int = 25, tier: str = "broad") -> dict[str, DataFrame]:
    spans = parse_windows(windows)
    cases = cut_lineage(profile.case_frame(built, tier))
    if cases.isEmpty():
        raise ValueError(f"no cases with an index date in tier {tier}")
    before = cut_lineage(profile.preindex_events(conditions, cases))
    labs = cut_lineage(profile.preindex_events(measurements, cases, "value"))
    summary = profile.event_summary(before, cases, "condition", spans).unionByName(
        profile.event_summary(labs, cases, "measurement", spans)
    )
    return {
        "availability": summary.unionByName(profile.observation_history(cases, spans), allowMissingColumns=True),
        "top_conditions": profile.top_concepts(before, "condition", spans, top_n),
        "top_measurements": profile.top_concepts(labs, "measurement", spans, top_n),
        "biomarkers": profile.biomarker_availability(labs, cases, spans),
    }


def variant_gwas(
    calls: DataFrame, variants: DataFrame, people: DataFrame, covariates: Sequence[str], outcome: str = "analysis_case",
    annotation: DataFrame | None = None, dense: bool = False, window_bp: int = 250_000, **limits,
) -> dict[str, DataFrame]:
    """Variant QC → per-variant regression → FDR, leads, λ and the plot tables.

    ``calls``: variant_id, person_id, n_alt. ``variants``: variant_id, chromosome, position, alleles.
    """
    people = cut_lineage(people)
    kept, dropped = association.stable_covariates(people, covariates, outcome)
    stats = genotypes.variant_stats(calls, people, outcome, dense)
    snp = genotypes.is_biallelic_snp(F.col("alleles"))
    flagged, funnel = genotypes.stored_with_funnel(genotypes.qc_flags(variants.withColumn("biallelic", snp).join(stats, "variant_id"), **limits))
    tested = flagged.filter("biallelic and qc_pass").drop("alleles")
    # a missing call takes the variant's mean dosage: with dense input an absent row, with sparse input a NULL one
    if dense:
        fill = tested.select("variant_id", (F.col("ac") / F.col("n_called")).alias("_fill_value"))
        exposures = calls.filter("n_alt is not null").withColumnRenamed("n_alt", "dosage").join(fill, "variant_id")
    else:
        held = calls.join(people.select("person_id").distinct(), "person_id", "left_semi").join(tested.select("variant_id"), "variant_id", "left_semi")
        exposures = genotypes.mean_imputed(held, people)
    fits = association.logistic_per_unit(
        exposures, people, ["variant_id"], kept, outcome, fill="_fill_value" if dense else None, panel=tested
    )
    full = cut_lineage(association.gwas_postprocess(tested.join(fits, "variant_id"), annotation))
    return {
        "qc_funnel": funnel,
        "results": full,
        "lead_hits": leads.lead_hits(full, window_bp),
        "lambda": association.genomic_control(full),
        "qq_points": association.qq_points(full),
        "manhattan_points": association.manhattan_points(full),
        "covariates": people.sparkSession.createDataFrame(
            [(c, "kept") for c in kept] + [(c, "dropped") for c in dropped], "covariate string, status string"
        ),
    }


def plp_panel(
    calls: DataFrame, annotation: DataFrame, samples_: DataFrame, covariates: Sequence[str], clinvar_terms: Sequence[str], plof_terms: Sequence[str],
    manifest: DataFrame | None = None, parts: Sequence[str] = ("variant_association", "gene_association", "person_summary"),
) -> dict[str, DataFrame]:
    """Primary-mask panel: variant and gene associations in every comparison set, and one row for each carrier.

    Only the asked ``parts`` are worked out.

    ``calls``: variant_id, person_id, n_alt. ``samples_``: comparison, person_id, outcome, covariates. A ``manifest``
    restricts the calls to its people, and must hold some.
    """
    masks = genotypes.variant_masks(annotation, clinvar_terms, plof_terms).filter("mask_primary").select("variant_id", "gene")
    held = calls if manifest is None else samples.restrict_to_manifest(calls, manifest)
    carried = held.filter("n_alt > 0").select("person_id", "variant_id", F.col("n_alt").alias("dosage"))
    masked = cut_lineage(carried.join(masks, "variant_id"))
    associate = lambda unit: association.panel_association(genotypes.max_dosage(masked, unit), samples_, [unit], covariates)
    makers = {
        "variant_association": lambda: associate("variant_id"),
        "gene_association": lambda: associate("gene"),
        "person_summary": lambda: genotypes.panel_person_summary(masked),
    }
    return {part: makers[part]() for part in parts}


def candidate_genotypes(
    raw: DataFrame, calls: DataFrame | str, genes: Sequence[str] | DataFrame, clinvar_terms: Sequence[str], plof_terms: Sequence[str], **limits
) -> DataFrame:
    """(person, variant, gene, dosage) of the candidate variants' calls.

    The candidates' merged intervals cut the calls first, so that few calls meet the exact join: ``calls`` is a table of
    calls, or the path of one that ``genotype_store.write_ranges`` wrote by contig, of which only the needed files are read.
    """
    found = cut_lineage(genotypes.candidate_variants(raw, genes, clinvar_terms, plof_terms, **limits))
    spans = cut_lineage(genotypes.merged_intervals(found.select("contig", "gene", "position")))
    if isinstance(calls, str):
        near = genotype_store.read_intervals(raw.sparkSession, calls, spans, contig="contig").filter("n_alt > 0")
    else:
        near = genotypes.in_intervals(calls.filter("n_alt > 0"), spans)
    exact = near.select("person_id", "variant_id", F.col("n_alt").alias("dosage")).join(found.select("variant_id", "gene"), "variant_id")
    return exact.groupBy("person_id", "variant_id", "gene").agg(F.max("dosage").alias("dosage"))


def table_gwas(
    dosages: DataFrame, people: DataFrame, covariates: Sequence[str], annotation: DataFrame | None = None, outcome: str = "analysis_case",
    min_maf: float = 0.01, min_mac: float = 5, window_bp: int = 250_000,
) -> dict[str, DataFrame]:
    """GWAS on a table of dosages: frequency filter from the dosages themselves, regression, annotation, leads and λ."""
    people = cut_lineage(people)
    held = cut_lineage(dosages.join(people.select("person_id").distinct(), "person_id", "left_semi"))
    counted = genotypes.maf_from_dosage(held, people.agg(F.count_distinct("person_id").alias("n_people")))
    tested = cut_lineage(counted.filter((F.col("maf") >= min_maf) & (F.col("minor_allele_count") >= min_mac)))
    exposures = held.join(tested.select("variant_id"), "variant_id", "left_semi")
    fits = association.logistic_per_unit(exposures, people, ["variant_id"], covariates, outcome, panel=tested)
    full = cut_lineage(association.gwas_postprocess(tested.join(fits, "variant_id"), annotation))
    out = {"results": full, "lambda": association.genomic_control(full)}
    return out | ({"lead_hits": leads.lead_hits(full, window_bp)} if {"chromosome", "position"} <= set(full.columns) else {})


def risk_score_study(
    gwas: DataFrame, positions: DataFrame, train_calls: DataFrame, test_calls: DataFrame, train: DataFrame, test: DataFrame,
    thresholds: Sequence[float], **clump_options,
) -> dict[str, DataFrame]:
    """Weights → clumping in train → scores of test people → metrics per threshold.

    A missing call of a test person takes the variant's mean dosage in train.
    """
    weights = cut_lineage(scores.valid_weights(gwas))
    clumps = scores.clump(weights, positions, train_calls, train.count(), **clump_options)
    index = clumps.filter(F.col("lead") == F.col("variant_id")).select("variant_id")
    kept = cut_lineage(scores.restricted_weights(weights, index).join(positions.select("variant_id", "ref"), "variant_id", "left"))
    means = genotypes.variant_means(train_calls, train)
    kept = cut_lineage(kept.join(means, "variant_id", "left").withColumn("flip", F.col("effect_allele") == F.col("ref")))
    table = cut_lineage(scores.person_scores(test_calls, kept, test, thresholds))
    return {"clumps": clumps, "weights": kept, "scores": table, "metrics": scores.prs_metrics(table, test, kept, thresholds)}


def score_diagnostics(rows: DataFrame, strata: Sequence[str] = (), iterations: int = 500) -> dict[str, DataFrame]:
    """Overall, decile, stratified, definite-only, bootstrap and recalibration tables of a test-set score.

    ``rows``: person_id, analysis_split, analysis_case, prs_score, optionally probability and strata columns.
    """
    rows = cut_lineage(rows.filter(F.col("analysis_case").isin(0, 1)))
    test = rows.filter("analysis_split = 'test'").withColumnRenamed("analysis_case", "y")
    scored = test.withColumnRenamed("prs_score", "score")
    out = {
        "overall": metrics.score_metrics(scored.select("person_id", "y", "score")),
        "deciles": metrics.decile_table(scored.select("person_id", "y", "score")),
        "bootstrap": metrics.bootstrap_intervals(scored.select("person_id", "y", "score"), iterations),
    }
    present = [c for c in strata if c in rows.columns]
    if present:
        cells = F.array(*[F.struct(F.lit(c).alias("stratum_variable"), F.coalesce(F.col(c).cast("string"), F.lit("missing")).alias("stratum")) for c in present])
        long = cut_lineage(scored.select("person_id", "y", "score", F.inline(cells)))
        out["stratified"] = metrics.score_metrics(long, ["stratum_variable", "stratum"])
    if {"definite_case", "case_tier"} <= set(rows.columns):
        definite = scored.filter((F.lower("case_tier") == "control") | (F.col("definite_case") == 1))
        out["definite_only"] = metrics.score_metrics(
            definite.select("person_id", F.coalesce(F.col("definite_case").cast("int"), F.lit(0)).alias("y"), "score")
        )
    if "probability" in rows.columns:
        prob = lambda part: rows.filter(F.col("analysis_split") == part).select(
            "person_id", F.col("analysis_case").alias("y"), F.col("probability").alias("score")
        ).filter("score is not null")
        fit = cut_lineage(metrics.recalibration(prob("train")))
        both = prob("test").withColumn("model", F.lit("raw")).unionByName(
            metrics.recalibrated(prob("test"), fit).withColumn("model", F.lit("recalibrated"))
        )
        both = cut_lineage(both)
        out["probability"] = metrics.score_metrics(both, ["model"], probability=True)
        out["calibration"] = metrics.calibration(metrics.quantile_bins(both, groups=["model"]), ["model"])
        out["recalibration"] = fit
    return out


def clinical_model(model_input: DataFrame, features: dict, eligibility: str | None = "primary_model_eligible", penalty: float = 1.0, folds: bool = True) -> dict[str, DataFrame]:
    """Fit, evaluation and curves, and with ``folds`` the cross-validation, which is fitted at once."""
    fitted = models.run_model(model_input, "analysis_case", features, eligibility, penalty)
    predictions = fitted["predictions"]
    test = predictions.filter("analysis_split = 'test'").select(
        "person_id", F.col("analysis_case").cast("int").alias("y"), F.col("predicted_probability").alias("score")
    )
    cv = models.cv_metrics(predictions.filter("analysis_split = 'train'"), "analysis_case", features, penalty) if folds else None
    out = {k: v for k, v in fitted.items() if k != "model"} | {
        "calibration": metrics.calibration(metrics.equal_count_bins(test)),
        "roc_points": metrics.curve_points(test, "roc"),
        "precision_recall_points": metrics.curve_points(test, "pr"),
        "top_coefficients": models.top_coefficients(fitted["coefficients"]),
    }
    return out if cv is None else out | {"cv_metrics": cv}


def incident_model(model_input: DataFrame, features: dict, penalty: float = 1.0, folds: bool = True) -> dict[str, DataFrame]:
    """The incident study's model: the tables of ``clinical_model`` and risk deciles of the test rows, equal in size.

    ``model_input``: rows of ``splits.incident_model_input``.
    """
    out = clinical_model(model_input, features, "case_control_eligible", penalty, folds)
    deciles = out["calibration"].withColumnRenamed("bin", "decile")
    keep = [c for c in ("person_id", "analysis_case", "analysis_split", "cv_fold", "baseline_date", "predicted_probability", "predicted_label") if c in out["predictions"].columns]
    return out | {"predictions": out["predictions"].select(*keep), "risk_deciles": deciles}


def clinical_score_model(
    model_input: DataFrame, table: DataFrame, features: dict, threshold_label: str, eligibility: str | None = "primary_model_eligible", penalty: float = 1.0,
    folds: bool = True,
) -> dict[str, DataFrame]:
    """Clinical features and one score, of people who have it; every table of ``clinical_model``.

    ``table``: person_id, threshold_label, prs_score of train and test people. The weights behind train people's scores
    may come from those people, so the test rows are the ones to read.
    """
    one = table.filter(F.col("threshold_label") == threshold_label).select("person_id", "threshold_label", F.col("prs_score").cast("double").alias("prs_score"))
    rows = cut_lineage(model_input.join(one.filter("prs_score is not null and not isnan(prs_score)"), "person_id"))
    spread = rows.filter("analysis_split = 'train'").agg(F.stddev_pop("prs_score")).first()[0]
    if not spread:
        raise ValueError("train scores have no variance")
    both = features | {"continuous": [*features.get("continuous", ()), ("prs_score", "prs_score_per_sd", "identity")]}
    out = clinical_model(rows, both, eligibility, penalty, folds)
    keep = ["person_id", "analysis_case", "analysis_split", "cv_fold", "match_group_id", eligibility, "threshold_label", "prs_score", "predicted_probability", "predicted_label"]
    return out | {
        "metrics": out["metrics"].withColumn("threshold_label", F.lit(threshold_label)),
        "predictions": out["predictions"].select(*[c for c in keep if c in out["predictions"].columns]),
    }


STAGES = ("prior", "panel", "burden", "gwas")


def association_study(
    tables: dict[str, DataFrame], rules: PhenotypeRules, match: Matching, calls: DataFrame, variants: DataFrame, annotation: DataFrame,
    panel: DataFrame, covariates: Sequence[str], clinvar_terms: Sequence[str], plof_terms: Sequence[str], folder: str,
    masks: Sequence[str] = ("primary",), stages: Sequence[str] = STAGES, **gwas,
) -> dict[str, str]:
    """Cohort, matching and the chosen association stages in one run, written with a manifest; returns the paths.

    ``tables``: person, periods, conditions, measurements, optionally ancestry and universe. ``calls``: variant_id,
    person_id, n_alt. ``panel``: variant_id, exact_test_model. Prior variants and the panel are tested in the comparison
    sets of the whole cohort, burden and single variants in the matched one.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}")
    study = case_control(rules=rules, match=match, **tables)
    out = {"cohort": study["cohort"], "matched": study["matched"], "qc": study["cohort_qc"].unionByName(study["matching_qc"])}
    carried = calls.filter("n_alt > 0").select("person_id", "variant_id", F.col("n_alt").alias("dosage"))
    if {"prior", "panel"} & set(stages):
        people = cut_lineage(association.comparison_samples(study["cohort"]))
    if "prior" in stages:
        exposures = association.apply_exposure_model(carried, panel)
        out["prior_association"] = association.panel_association(exposures, people, ["variant_id"], covariates, panel=panel.select("variant_id").distinct())
    if "panel" in stages:
        out |= plp_panel(calls, annotation, people, covariates, clinvar_terms, plof_terms)
    if "burden" in stages:
        named = genotypes.variant_masks(annotation, clinvar_terms, plof_terms).select("variant_id", "gene", *genotypes.MASK_COLUMNS.values())
        rows = association.burden_exposures(carried.join(named, "variant_id"), masks, genotypes.MASK_COLUMNS)
        out["gene_burden"] = association.gene_burden(rows, study["matched"], covariates, "analysis_case")
    if "gwas" in stages:
        found = variant_gwas(calls, variants, study["matched"], covariates, **gwas)
        out |= {name: found[name] for name in ("results", "lead_hits", "lambda")}
    config = {"stages": sorted(stages), "masks": list(masks), "covariates": list(covariates)}
    return write_outputs(calls.sparkSession, out, folder, config)
