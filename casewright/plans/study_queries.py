"""Whole studies as queries: panels, candidate genotypes, the table-path GWAS, and the paths that only large data take."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casewright.operators import association, genotypes, matching
from casewright.plans import drivers
from casewright.plans.cohort_queries import tiered
from casewright.plans.fit_sql import newton_sql
from casewright.plans.genotype_queries import (
    BURDEN_SQL, COMPARISON_SQL, COVARIATES, DESIGN_SQL, MASK_SQL, SAMPLE_SQL, _bh_sql, _burden_rows, _wald_sql, called, fisher_sql, masked_calls, sample,
)
from casewright.plans.model_queries import MATCH_SQL
from casewright.plans.registry import query
from casewright.session import cut_lineage, intermediate_path
from casewright.sources import genotype_store
from casewright.sources.lens import CLINVAR_TERMS, MATCHING, PLOF_TERMS, Lens


def _panel_sql(unit: str) -> str:
    """Carrier tests and regressions on the primary mask, by ``unit``, in every comparison set."""
    second = _bh_sql("fdr_q_t", "regression_p", "rq", "comparison")
    # the second FDR counts and ranks under names of its own
    second = second.replace("AS bh_n", "AS bh_m").replace("AS bh_rk", "AS bh_k").replace("* bh_n / bh_rk", "* bh_m / bh_k").replace("ORDER BY bh_rk ROWS", "ORDER BY bh_k ROWS")
    return (
        SAMPLE_SQL
        + MASK_SQL
        + COMPARISON_SQL
        + f""", px AS (SELECT {unit} AS unit, person_id, MAX(dosage) AS x FROM masked WHERE mask_primary GROUP BY ALL), pan AS (SELECT DISTINCT unit FROM px),
pc AS (SELECT comparison, unit, COUNT(*) FILTER (WHERE outcome = 1) AS a, COUNT(*) FILTER (WHERE outcome = 0) AS c FROM px JOIN cmp USING (person_id) WHERE x >= 1 GROUP BY 1, 2),
cells AS (SELECT ctot.comparison || '|' || pan.unit AS id, ctot.comparison, pan.unit, COALESCE(a, 0) AS a, n_cases - COALESCE(a, 0) AS b, COALESCE(c, 0) AS c, n_controls - COALESCE(c, 0) AS d
  FROM pan CROSS JOIN ctot LEFT JOIN pc ON pc.comparison = ctot.comparison AND pc.unit = pan.unit)
"""
        + fisher_sql("cells")
        + """, prows AS (SELECT cmp.comparison, pan.unit, 1.0::DOUBLE AS x0, s.pc1 AS x1, COALESCE(x, 0)::DOUBLE AS x2, cmp.outcome AS y
  FROM pan CROSS JOIN cmp JOIN sampl s ON s.person_id = cmp.person_id LEFT JOIN px ON px.unit = pan.unit AND px.person_id = cmp.person_id)
"""
        + newton_sql("pfit", "prows", ["comparison", "unit"], 3)
        + _wald_sql("pfit", "comparison, unit", 2)
        + ", both_p AS (SELECT c.comparison, c.unit, a, c, f.p AS fisher_p, beta, regression_p FROM cells c JOIN fish f USING (id) JOIN wald w ON w.comparison = c.comparison AND w.unit = c.unit)"
        + _bh_sql("both_p", "fisher_p", "fdr_q", "comparison")
        + second
        + f"""SELECT comparison, unit AS {unit}, a AS case_carriers, c AS control_carriers, ROUND(fisher_p, 4) AS fisher_p, ROUND(fdr_q, 4) AS fdr_q, ROUND(beta, 4) AS beta,
  ROUND(regression_p, 4) AS regression_p, ROUND(rq, 4) AS regression_fdr_q FROM rq_t"""
    )


def _panel(lens: Lens, part: str) -> DataFrame:
    people = sample(lens)
    compared = association.comparison_samples(people)
    return drivers.plp_panel(called(lens), lens.annotation, compared, ["pc1"], CLINVAR_TERMS, PLOF_TERMS, parts=[part])[part]


PANEL_COLUMNS = ["case_carriers", "control_carriers", "fisher_p", "fdr_q", "beta", "regression_p", "regression_fdr_q"]


@query("plp_panel_variants", _panel_sql("variant_id"), decimals=4)
def panel_variants(lens: Lens) -> DataFrame:
    return _panel(lens, "variant_association").select("comparison", "variant_id", *PANEL_COLUMNS)


@query("plp_panel_genes", _panel_sql("gene"), decimals=4)
def panel_genes(lens: Lens) -> DataFrame:
    return _panel(lens, "gene_association").select("comparison", "gene", *PANEL_COLUMNS)


@query(
    "candidate_genotypes",
    MASK_SQL.replace(", masks0", ", called AS (SELECT person_id, variant_id, CASE WHEN ft = 'PASS' THEN dosage END AS n_alt FROM genotype), masks0", 1)
    + "SELECT person_id, variant_id, gene, MAX(dosage) AS dosage FROM masked WHERE mask_primary AND gene IN ('Brand#13', 'Brand#25', 'Brand#42') GROUP BY ALL",
)
def candidate_genotypes(lens: Lens) -> DataFrame:
    """Calls of the candidate variants: of the stored calls only the files in the candidates' merged intervals are read."""
    wide = lens.annotation.withColumns({"vid": F.col("variant_id"), "contig": F.col("chromosome"), "ref_allele": F.lit("A"), "alt_allele": F.lit("C"), "gene_symbol": F.col("gene")})
    raw = wide.withColumns({"gnomad_max_af": F.col("max_af"), "clinvar_classification": F.col("clinvar_significance")})
    calls = called(lens).select("person_id", "variant_id", F.col("chromosome").alias("contig"), "position", "n_alt")
    stored = genotype_store.write_ranges(calls, intermediate_path(lens.spark, "genotypes"), "contig")
    found = drivers.candidate_genotypes(raw, stored, ["Brand#13", "Brand#25", "Brand#42"], CLINVAR_TERMS, PLOF_TERMS)
    return found.select("person_id", "variant_id", "gene", "dosage")


TABLE_SQL = (
    SAMPLE_SQL
    + DESIGN_SQL
    + """, hd AS (SELECT variant_id, person_id, dosage::DOUBLE AS x FROM genotype SEMI JOIN sampl USING (person_id)),
tst AS (SELECT variant_id, SUM(x) AS mac, SUM(x) / (2.0 * (SELECT COUNT(*) FROM sampl)) AS maf FROM hd GROUP BY 1 HAVING SUM(x) / (2.0 * (SELECT COUNT(*) FROM sampl)) >= 0.01 AND SUM(x) >= 5),
trows AS (SELECT t.variant_id, 1.0::DOUBLE AS x0, pc1 AS x1, pc2 AS x2, is_female AS x3, COALESCE(x, 0)::DOUBLE AS x4, outcome AS y
  FROM tst t CROSS JOIN dsg d LEFT JOIN hd ON hd.variant_id = t.variant_id AND hd.person_id = d.person_id)
"""
    + newton_sql("tfit", "trows", ["variant_id"], 5)
    + _wald_sql("tfit", "variant_id", 4)
)


def _table_gwas(lens: Lens) -> dict[str, DataFrame]:
    annotation = lens.annotation.select("variant_id", "chromosome", "position", "gene", "max_af")
    return drivers.table_gwas(lens.genotype.select("variant_id", "person_id", "dosage"), sample(lens), COVARIATES, annotation, "outcome")


@query(
    "table_gwas",
    TABLE_SQL
    + _bh_sql("wald", "regression_p", "fdr_q")
    + """SELECT variant_id, gene, position, ROUND(maf, 4) AS maf, mac AS minor_allele_count, ROUND(beta, 4) AS beta, ROUND(regression_p, 4) AS regression_p, ROUND(fdr_q, 4) AS fdr_q, n_samples
FROM fdr_q_t JOIN tst USING (variant_id) JOIN annotation USING (variant_id)""",
    decimals=4,
)
def table_gwas(lens: Lens) -> DataFrame:
    return _table_gwas(lens)["results"].select("variant_id", "gene", "position", "maf", "minor_allele_count", "beta", "regression_p", "fdr_q", "n_samples")


@query(
    "table_gwas_lambda",
    TABLE_SQL + "SELECT ROUND(quantile_cont(beta * beta / (se * se), 0.5) / 0.4549364, 4) AS lambda_gc FROM wald WHERE regression_p > 0 AND regression_p <= 1",
    decimals=4,
)
def table_lambda(lens: Lens) -> DataFrame:
    return _table_gwas(lens)["lambda"]


@query(
    "matched_pairs_in_rounds",
    MATCH_SQL + "SELECT case_id, control_id, match_rank, age AS age_at_case_index FROM pair",
)
def matched_in_rounds(lens: Lens) -> DataFrame:
    """Every stratum by rounds over short candidate lists, as strata too large for a task are matched."""
    cases, controls = matching.match_inputs(cut_lineage(tiered(lens)), MATCHING)
    return matching.assign_controls(cases, controls, MATCHING, stratum_limit=0, chunk=200)


@query(
    "burden_regression_in_blocks",
    BURDEN_SQL
    + DESIGN_SQL
    + """, bx AS (SELECT mask, gene, person_id, MAX(dosage) AS x FROM mk GROUP BY ALL),
brows AS (SELECT c.mask, c.gene, 1.0::DOUBLE AS x0, pc1 AS x1, pc2 AS x2, is_female AS x3, COALESCE(x, 0)::DOUBLE AS x4, outcome AS y
  FROM cells c CROSS JOIN dsg d LEFT JOIN bx ON bx.mask = c.mask AND bx.gene = c.gene AND bx.person_id = d.person_id)
"""
    + newton_sql("bfit", "brows", ["mask", "gene"], 5)
    + _wald_sql("bfit", "mask, gene", 4)
    + "SELECT mask, gene, ROUND(beta, 4) AS beta, ROUND(se, 4) AS se, ROUND(regression_p, 4) AS regression_p, n_samples FROM wald",
    decimals=4,
)
def burden_in_blocks(lens: Lens) -> DataFrame:
    """The regression by grouped sums over blocks of people, as cohorts too large to broadcast are fitted."""
    people = sample(lens)
    kept = _burden_rows(lens).join(people.select("person_id"), "person_id", "left_semi")
    exposures = genotypes.max_dosage(kept, "mask", "gene")
    fits = association.logistic_per_unit(exposures, people, ["mask", "gene"], COVARIATES, broadcast_limit=0)
    return fits.select("mask", "gene", "beta", "se", "regression_p", "n_samples")


GENES = ("Brand#13", "Brand#25", "Brand#42")


@query(
    "targeted_gene_burden",
    BURDEN_SQL
    + f"""SELECT replace(mask, 'primary', 'unheard_of') AS mask, gene, n_variants_in_mask, a AS case_carriers, c AS control_carriers, ROUND(p, 6) AS fisher_p
  FROM cells JOIN fish USING (id) WHERE gene IN {GENES} AND mask <> 'pLoF'""",
)
def targeted_burden(lens: Lens) -> DataFrame:
    """The burden of listed genes alone; a mask of an unknown name is the primary one."""
    people = sample(lens)
    rows = association.burden_exposures(masked_calls(lens), ["unheard_of", "pLoF_or_REVEL_0_8"], genotypes.MASK_COLUMNS, GENES)
    kept = cut_lineage(rows.join(people.select("person_id"), "person_id", "left_semi"))
    n = kept.groupBy("mask", "gene").agg(F.count_distinct("variant_id").alias("n_variants_in_mask"))
    tests = association.carrier_tests(genotypes.max_dosage(kept, "mask", "gene"), people, ["mask", "gene"])
    return n.join(tests, ["mask", "gene"]).select("mask", "gene", "n_variants_in_mask", "case_carriers", "control_carriers", "fisher_p")


@query(
    "smallest_p_preview",
    """, r AS (SELECT variant_id, CASE WHEN position % 7 <> 0 THEN max_af END AS regression_p FROM annotation)
SELECT variant_id, ROUND(regression_p, 6) AS regression_p FROM r WHERE regression_p IS NOT NULL ORDER BY r.regression_p, variant_id LIMIT 25""",
)
def smallest_p(lens: Lens) -> DataFrame:
    """The report of the smallest defined p-values, a top-k one."""
    p = F.when(F.col("position") % 7 != 0, F.col("max_af"))
    return association.preview(lens.annotation.select("variant_id", p.alias("regression_p")), 25)


@query(
    "covariate_stability",
    SAMPLE_SQL
    + """, v AS (SELECT outcome, UNNEST(['pc1', 'pc2', 'is_female', 'one_value', 'cases_only']) AS covariate, UNNEST([pc1, pc2, CAST(is_female AS DOUBLE), 1.0::DOUBLE, CAST(outcome AS DOUBLE)]) AS x FROM sampl)
SELECT covariate, CASE WHEN COUNT(DISTINCT x) > 1 AND NOT (bool_and(x IS NULL OR x IN (0, 1)) AND (COUNT(*) FILTER (x = 1 AND outcome = 1) = 0 OR COUNT(*) FILTER (x = 1 AND outcome = 0) = 0)) THEN 'kept' ELSE 'dropped' END AS status
FROM v GROUP BY 1""",
)
def covariate_stability(lens: Lens) -> DataFrame:
    """Which covariates a regression keeps, one constant column and one that only cases have among them."""
    people = sample(lens).withColumns({"one_value": F.lit(1.0), "cases_only": F.col("outcome").cast("double")})
    kept, dropped = association.stable_covariates(people, ["pc1", "pc2", "is_female", "one_value", "cases_only"])
    return people.sparkSession.createDataFrame([(c, "kept") for c in kept] + [(c, "dropped") for c in dropped], "covariate string, status string")
