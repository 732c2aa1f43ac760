"""Sample restriction, manifests for external tools and their funnels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from casewright.operators.predicates import case_control_definition, complete_cases, require_columns, require_nonempty
from casewright.operators.scores import sample_funnel

# Accepted id columns, in order of preference.
ID_COLUMNS = ("person_id", "research_id", "IID", "FID", "s", "sample_id")


def id_list(df: DataFrame) -> DataFrame:
    """Distinct ``person_id`` from the first known id column."""
    column = next((c for c in ID_COLUMNS if c in df.columns), None)
    if column is None:
        raise ValueError(f"no id column among {', '.join(df.columns)}")
    return df.select(F.trim(F.col(column).cast("string")).alias("person_id")).filter("person_id <> ''").distinct()


def restrict_to_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.withColumn("person_id", F.col("person_id").cast("string")).join(id_list(ids), "person_id", "left_semi")


def is_exclusion_list(name: str) -> bool:
    return "flagged" in name.lower() or "remove" in name.lower()


def id_universe(wgs_ids: DataFrame | None = None, listed: DataFrame | None = None, list_name: str = "") -> DataFrame | None:
    """WGS ids ∩ include list, or WGS ids − list when its name says it lists exclusions."""
    if listed is None:
        return None if wgs_ids is None else id_list(wgs_ids)
    if is_exclusion_list(list_name):
        if wgs_ids is None:
            raise ValueError("an exclusion list needs a universe of ids")
        return id_list(wgs_ids).join(id_list(listed), "person_id", "left_anti")
    return id_list(listed) if wgs_ids is None else id_list(wgs_ids).join(id_list(listed), "person_id", "left_semi")


def restrict_to_manifest(df: DataFrame, manifest: DataFrame) -> DataFrame:
    """Semi join on a manifest that must exist and hold rows."""
    return restrict_to_ids(df, require_nonempty(require_columns(manifest, ["person_id"]), "sample manifest"))


def sample_manifest(people: DataFrame, flag: str) -> DataFrame:
    return people.filter(F.col(flag) == 1).select(F.trim("person_id").alias("person_id")).filter("person_id <> ''").distinct()


def gwas_funnel(rows: DataFrame, genotyped: DataFrame, split: str = "train", eligibility: str = "primary_model_eligible") -> DataFrame:
    """People left after split, eligibility, case-control definition and genotype overlap."""
    require_columns(rows, ["person_id", "analysis_case", "analysis_split", eligibility])
    marked = rows.join(id_list(genotyped).withColumn("_in", F.lit(True)), "person_id", "left")
    steps = [
        ("input", F.lit(True)),
        ("split", F.col("analysis_split") == split),
        ("eligibility", F.coalesce(F.col(eligibility).cast("int"), F.lit(0)) == 1),
        ("definition", case_control_definition()),
        ("genotyped", F.col("_in")),
    ]
    return sample_funnel(marked, steps)


def gwas_manifests(rows: DataFrame, covariates: Sequence[str], outcome: str = "analysis_case", fid: str | None = "0") -> dict[str, DataFrame]:
    """Keep, phenotype, covariate and complete-case frames. A person matched twice keeps the lowest group."""
    order = [c for c in ("match_group_id", "match_rank") if c in rows.columns]
    columns = [outcome, *covariates]
    if order:
        first = rows.groupBy("person_id").agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_r"))
    else:
        first = rows.groupBy("person_id").agg(F.min(F.struct(*columns)).alias("_r"))
    people = first.select("person_id", "_r.*")
    ids = [(F.lit(fid) if fid is not None else F.col("person_id")).alias("FID"), F.col("person_id").alias("IID")]
    complete = complete_cases(people, ["person_id"], columns)
    return {
        "keep": complete.select(*ids),
        "phenotype": complete.select(*ids, outcome),
        "covariates": complete.select(*ids, *covariates),
        "complete": complete.select(*ids, outcome, *covariates),
    }


def split_sample_lists(rows: DataFrame, covariates: Sequence[str], outcome: str = "analysis_case") -> dict[str, DataFrame]:
    """Train, test and train-control lists for a sparse genotype model."""
    frames = {s: gwas_manifests(rows.filter(F.col("analysis_split") == s), covariates, outcome)["complete"] for s in ("train", "test")}
    frames["train_controls"] = frames["train"].filter(F.col(outcome) == 0).select("FID", "IID")
    return frames


def shared_covariates(train: Sequence[str], test: Sequence[str]) -> tuple[list[str], list[str]]:
    """(kept in both, dropped from either)."""
    kept = [c for c in train if c in test]
    return kept, sorted(set(train) ^ set(test))


def genotyped_sample(cohort: DataFrame, fam: DataFrame) -> DataFrame:
    return restrict_to_ids(cohort, fam.select("IID"))
