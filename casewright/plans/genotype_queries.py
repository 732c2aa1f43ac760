"""Genotype QC, annotation, intervals, association and lead hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casewright.functions.scalars import autosomes
from casewright.operators import association, genotypes, leads
from casewright.operators.ranking import benjamini_hochberg
from casewright.plans.cohort_queries import TIER_SQL, tiered
from casewright.plans.fit_sql import newton_sql, tail_sql
from casewright.plans.registry import query
from casewright.session import cut_lineage, intermediate_path
from casewright.sources import genotype_store
from casewright.sources.lens import CLINVAR_TERMS, PLOF_TERMS, Lens

QC = dict(min_maf=0.005, min_mac=5, min_call_rate=0.9, min_hwe_p=1e-3)
COVARIATES = ["pc1", "pc2", "is_female"]


def sample(lens: Lens) -> DataFrame:
    """Broad cases and eligible controls with their covariates, written once because every test reads it again."""
    c = tiered(lens).filter((F.col("broad_case") == 1) | F.col("eligible_control"))
    return cut_lineage(
        c.select(
            "person_id", F.col("broad_case").alias("outcome"), "broad_case", "definite_case", "eligible_control",
            "ancestry_pred", "pc1", "pc2", "pc3", "is_female",
        )
    )


def called(lens: Lens) -> DataFrame:
    """Genotypes with the filter mask applied."""
    return lens.genotype.withColumn("n_alt", genotypes.passed_call(F.col("dosage"), F.col("ft")))


def sample_calls(lens: Lens, people: DataFrame) -> DataFrame:
    """The people's calls, written once for queries that read them several times."""
    held = called(lens).select("variant_id", "person_id", "n_alt")
    return cut_lineage(held.join(people.select("person_id"), "person_id", "left_semi"))


def masked_calls(lens: Lens) -> DataFrame:
    masks = genotypes.variant_masks(lens.annotation, CLINVAR_TERMS, PLOF_TERMS)
    keep = masks.select("variant_id", "gene", *genotypes.MASK_COLUMNS.values())
    return called(lens).filter("n_alt > 0").select("person_id", "variant_id", F.col("n_alt").alias("dosage")).join(keep, "variant_id")


SAMPLE_SQL = (
    TIER_SQL
    + """, sampl AS (SELECT person_id, broad_case AS outcome, broad_case, definite_case, eligible_control, ancestry_pred, pc1, pc2, pc3, is_female
  FROM cohort WHERE broad_case = 1 OR eligible_control = 1),
called AS (SELECT person_id, variant_id, chromosome, position, CASE WHEN ft = 'PASS' THEN dosage END AS n_alt FROM genotype)
"""
)


def fisher_sql(source: str) -> str:
    """CTE ``fish``: source rows (id, a, b, c, d) plus the two-sided Fisher p."""
    return f"""
, f_k AS (SELECT id, a, b, c, d, UNNEST(range(GREATEST(0, (a + b) + (a + c) - (a + b + c + d)), LEAST(a + b, a + c) + 1)) AS k FROM {source}),
f_w AS (SELECT id, a, k, -(lgamma(k + 1) + lgamma(a + b - k + 1) + lgamma(a + c - k + 1) + lgamma(d - a + k + 1)) AS lw FROM f_k),
f_m AS (SELECT id, MAX(lw) AS mx, MAX(CASE WHEN k = a THEN lw END) AS ob FROM f_w GROUP BY 1),
fish AS (SELECT w.id, LEAST(1.0::DOUBLE, SUM(CASE WHEN exp(lw - mx) <= exp(ob - mx) * (1 + 1e-7) THEN exp(lw - mx) ELSE 0 END) / SUM(exp(lw - mx))) AS p
  FROM f_w w JOIN f_m m ON w.id = m.id GROUP BY 1)
"""


def hwe_sql(y: int) -> str:
    return f"""
, h{y}_k AS (SELECT variant_id, hom_ref_{y} + het_{y} + hom_alt_{y} AS n, het_{y} AS obs, 2 * LEAST(hom_ref_{y}, hom_alt_{y}) + het_{y} AS minor,
  UNNEST(range((2 * LEAST(hom_ref_{y}, hom_alt_{y}) + het_{y}) % 2, 2 * LEAST(hom_ref_{y}, hom_alt_{y}) + het_{y} + 1, 2)) AS h FROM st),
h{y}_w AS (SELECT variant_id, h, obs, h * ln(2) - lgamma((minor - h) // 2 + 1) - lgamma(h + 1) - lgamma(n - h - (minor - h) // 2 + 1) AS lw FROM h{y}_k),
h{y}_m AS (SELECT variant_id, MAX(lw) AS mx, MAX(CASE WHEN h = obs THEN lw END) AS ob FROM h{y}_w GROUP BY 1),
h{y} AS (SELECT w.variant_id, LEAST(1.0::DOUBLE, (SUM(CASE WHEN exp(lw - mx) <= exp(ob - mx) * (1 + 1e-7) THEN exp(lw - mx) ELSE 0 END)
  - 0.5 * MAX(exp(ob - mx))) / SUM(exp(lw - mx))) AS p FROM h{y}_w w JOIN h{y}_m m ON w.variant_id = m.variant_id GROUP BY 1)
"""


STATS_SQL = (
    SAMPLE_SQL
    + """, tot AS (SELECT COUNT(*) AS n_total, COUNT(*) FILTER (WHERE outcome = 0) AS n0, COUNT(*) FILTER (WHERE outcome = 1) AS n1 FROM sampl),
g AS (SELECT variant_id, SUM(n_alt) AS ac, COUNT(*) FILTER (WHERE n_alt IS NULL) AS nulls,
  COUNT(*) FILTER (WHERE n_alt = 1 AND outcome = 0) AS het_0, COUNT(*) FILTER (WHERE n_alt = 2 AND outcome = 0) AS hom_alt_0,
  COUNT(*) FILTER (WHERE n_alt = 1 AND outcome = 1) AS het_1, COUNT(*) FILTER (WHERE n_alt = 2 AND outcome = 1) AS hom_alt_1,
  COUNT(*) FILTER (WHERE n_alt IS NULL AND outcome = 0) AS null_0, COUNT(*) FILTER (WHERE n_alt IS NULL AND outcome = 1) AS null_1
  FROM called JOIN sampl USING (person_id) GROUP BY 1),
st AS (SELECT g.*, n_total, n_total - nulls AS n_called, 2 * (n_total - nulls) AS an,
  n0 - het_0 - hom_alt_0 - null_0 AS hom_ref_0, n1 - het_1 - hom_alt_1 - null_1 AS hom_ref_1 FROM g, tot)
"""
    + hwe_sql(0)
    + hwe_sql(1)
    + """, stats AS (SELECT st.variant_id, COALESCE(ac, 0) AS ac, n_called, an, CAST(COALESCE(ac, 0) AS DOUBLE) / an AS af,
  LEAST(CAST(COALESCE(ac, 0) AS DOUBLE) / an, 1.0::DOUBLE - CAST(COALESCE(ac, 0) AS DOUBLE) / an) AS maf,
  LEAST(COALESCE(ac, 0), an - COALESCE(ac, 0)) AS mac, CAST(n_called AS DOUBLE) / n_total AS call_rate,
  h0.p AS hwe_control_p, h1.p AS hwe_case_p FROM st LEFT JOIN h0 USING (variant_id) LEFT JOIN h1 USING (variant_id))
"""
)


@query(
    "variant_qc_stats",
    STATS_SQL
    + """SELECT variant_id, CAST(ac AS BIGINT) AS ac, n_called, an, ROUND(af, 6) AS af, ROUND(maf, 6) AS maf, CAST(mac AS BIGINT) AS mac,
  ROUND(call_rate, 6) AS call_rate, ROUND(hwe_control_p, 6) AS hwe_control_p, ROUND(hwe_case_p, 6) AS hwe_case_p FROM stats""",
)
def variant_stats(lens: Lens) -> DataFrame:
    return genotypes.variant_stats(called(lens), sample(lens), "outcome").select(
        "variant_id", "ac", "n_called", "an", "af", "maf", "mac", "call_rate", "hwe_control_p", "hwe_case_p"
    )


def flagged(lens: Lens, people: DataFrame | None = None, calls: DataFrame | None = None) -> DataFrame:
    """``calls``: a written table of the people's calls, where the caller reads it again."""
    people = sample(lens) if people is None else people
    stats = genotypes.variant_stats(called(lens) if calls is None else calls, people, "outcome", stored=calls is not None)
    snps = lens.annotation.select("variant_id", genotypes.is_biallelic_snp(F.col("alleles")).alias("biallelic"))
    return genotypes.qc_flags(snps.join(stats, "variant_id"), **QC)


@query(
    "variant_qc_funnel",
    STATS_SQL
    + f""", fl AS (SELECT biallelic, biallelic AND maf >= {QC['min_maf']} AS f1, mac >= {QC['min_mac']} AS f2, call_rate >= {QC['min_call_rate']} AS f3,
  hwe_control_p >= {QC['min_hwe_p']} AS f4 FROM annotation JOIN stats USING (variant_id)),
c AS (SELECT COUNT(*) AS c0, COUNT(*) FILTER (WHERE biallelic) AS c1, COUNT(*) FILTER (WHERE f1) AS c2, COUNT(*) FILTER (WHERE f1 AND f2) AS c3,
  COUNT(*) FILTER (WHERE f1 AND f2 AND f3) AS c4, COUNT(*) FILTER (WHERE f1 AND f2 AND f3 AND f4) AS c5 FROM fl)
SELECT 0 AS step, 'input' AS filter, c0 AS rows_before, c0 AS rows_after, 0 AS rows_removed FROM c
UNION ALL SELECT 1, 'biallelic_snp', c0, c1, c0 - c1 FROM c UNION ALL SELECT 2, 'maf', c1, c2, c1 - c2 FROM c
UNION ALL SELECT 3, 'mac', c2, c3, c2 - c3 FROM c UNION ALL SELECT 4, 'call_rate', c3, c4, c3 - c4 FROM c
UNION ALL SELECT 5, 'control_hwe', c4, c5, c4 - c5 FROM c""",
)
def variant_funnel(lens: Lens) -> DataFrame:
    return genotypes.stored_with_funnel(flagged(lens))[1]


@query(
    "allele_maf_from_dosage",
    SAMPLE_SQL
    + """, m AS (SELECT variant_id, SUM(CAST(dosage AS DOUBLE)) AS mac FROM genotype SEMI JOIN sampl USING (person_id) GROUP BY 1)
SELECT variant_id, mac AS minor_allele_count, ROUND(mac / (2.0::DOUBLE * (SELECT COUNT(*) FROM sampl)), 6) AS maf FROM m""",
)
def dosage_maf(lens: Lens) -> DataFrame:
    people = sample(lens)
    n = people.agg(F.count(F.lit(1)).alias("n_people"))
    return genotypes.maf_from_dosage(lens.genotype.join(people.select("person_id"), "person_id", "left_semi"), n)


@query(
    "multiallelic_split",
    """, calls AS (SELECT person_id, variant_id, dosage FROM genotype)
SELECT variant_id, alt, SUM(n_alt) AS ac, COUNT(n_alt) AS n FROM (
  SELECT variant_id, 'C' AS alt, CASE WHEN dosage = 2 THEN 1 ELSE 1 END AS n_alt FROM calls
  UNION ALL SELECT variant_id, 'T', CASE WHEN dosage = 2 THEN 1 ELSE 0 END FROM calls) GROUP BY 1, 2""",
)
def multiallelic(lens: Lens) -> DataFrame:
    calls = lens.genotype.select(
        "variant_id",
        F.array(F.lit("A"), F.lit("C"), F.lit("T")).alias("alleles"),
        # stored with local alleles: heterozygous calls carry alleles 0/1, the others 1/2
        genotypes.local_to_global(
            F.when(F.col("dosage") == 2, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0), F.lit(1))),
            F.array(F.lit(0), F.lit(1), F.lit(2)),
        ).alias("gt"),
    )
    return genotypes.split_multiallelic(calls).groupBy("variant_id", "alt").agg(
        F.sum("n_alt").alias("ac"), F.count("n_alt").alias("n")
    )


MASK_SQL = """
, masks0 AS (SELECT *, contains(lower(clinvar_significance), 'red') AS plp, contains(lower(consequence), 'promo') AS plof,
  revel >= 0.8 AS rv, max_af <= 0.001 AS af FROM annotation),
masks AS (SELECT variant_id, gene, af AND (plp OR plof OR rv) AS mask_primary, af AND plof AS mask_plof, af AND plp AS mask_clinvar_plp,
  af AND (plof OR rv) AS mask_plof_or_revel FROM masks0),
masked AS (SELECT c.person_id, c.n_alt AS dosage, m.* FROM called c JOIN masks m USING (variant_id) WHERE n_alt > 0)
"""


@query(
    "variant_masks",
    SAMPLE_SQL + MASK_SQL
    + "SELECT variant_id, gene, mask_primary::INT AS mask_primary, mask_plof::INT AS mask_plof, mask_clinvar_plp::INT AS mask_clinvar_plp, mask_plof_or_revel::INT AS mask_plof_or_revel FROM masks",
)
def masks(lens: Lens) -> DataFrame:
    return genotypes.variant_masks(lens.annotation, CLINVAR_TERMS, PLOF_TERMS).select(
        "variant_id", "gene", *genotypes.MASK_COLUMNS.values()
    )


@query(
    "transcript_collapse",
    """SELECT 'chr' || chromosome || ':' || position AS variant_id, gene, string_agg(DISTINCT trim(clinvar_significance), ';' ORDER BY trim(clinvar_significance)) AS clinvar_significance,
  string_agg(DISTINCT trim(consequence), ';' ORDER BY trim(consequence)) AS consequence, MAX(revel) AS revel, MAX(max_af) AS max_af
FROM (SELECT CAST(1 + p_partkey % 22 AS VARCHAR) AS chromosome, (1 + p_partkey % 50) AS position, p_brand AS gene, p_type AS consequence,
  CAST(p_partkey % 100 AS DOUBLE) / 100.0::DOUBLE AS revel, GREATEST(CAST(p_size AS DOUBLE) / 25000.0::DOUBLE, CAST(p_partkey % 7 AS DOUBLE) / 1000.0::DOUBLE) AS max_af, p_name AS clinvar_significance FROM part) GROUP BY 1, 2""",
)
def transcripts(lens: Lens) -> DataFrame:
    key = F.col("p_partkey")
    raw = lens.table("part").select(
        F.lit("").alias("vid"),
        F.concat(F.lit("chr"), (1 + key % 22).cast("string")).alias("contig"),
        (1 + key % 50).cast("string").alias("position"),
        F.lit("G").alias("ref_allele"),
        F.lit("A").alias("alt_allele"),
        F.col("p_brand").alias("gene_symbol"),
        F.col("p_type").alias("consequence"),
        ((key % 100) / 100.0).cast("string").alias("revel"),
        (F.col("p_size") / 25000.0).cast("string").alias("gnomad_max_af"),
        ((key % 7) / 1000.0).cast("string").alias("gvs_max_af"),
        F.lit("not a number").alias("gvs_all_af"),
        F.col("p_name").alias("clinvar_classification"),
    )
    brands = lens.table("part").select(F.col("p_brand").alias("gene")).distinct()
    collapsed = genotypes.collapse_transcripts(genotypes.annotation_candidates(raw, brands))
    return collapsed.select(
        F.concat("contig", F.lit(":"), F.col("position").cast("string")).alias("variant_id"),
        "gene", "clinvar_significance", "consequence", "revel", "max_af",
    )


INTERVAL_SQL = """
, spans AS (SELECT chromosome AS contig, gene, GREATEST(1, MIN(position) - 1000) AS s, MAX(position) + 1000 AS e FROM (
    SELECT chromosome, gene || CAST(position // 2000000 AS VARCHAR) AS gene, position FROM annotation) GROUP BY 1, 2),
io AS (SELECT *, MAX(e) OVER (PARTITION BY contig ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
ig AS (SELECT *, SUM(CASE WHEN reach IS NULL OR s > reach + 50000 THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM io),
ivals AS (SELECT contig, MIN(s) AS s, MAX(e) AS e FROM ig GROUP BY contig, g)
"""


def _gene_blocks(lens: Lens) -> DataFrame:
    block = F.floor(F.col("position") / 2_000_000).cast("string")
    return lens.annotation.select(
        F.col("chromosome").alias("contig"), F.concat("gene", block).alias("gene"), "position"
    )


@query("merged_intervals", INTERVAL_SQL + "SELECT contig, s AS start, e AS \"end\", contig || ':' || s || '-' || e AS interval FROM ivals")
def merged(lens: Lens) -> DataFrame:
    return genotypes.merged_intervals(_gene_blocks(lens))


@query(
    "interval_restricted_calls",
    INTERVAL_SQL
    + """, plp AS (SELECT chromosome AS contig, gene, position FROM annotation WHERE contains(clinvar_significance, 'red') AND contains(consequence, 'PROMO')),
sp AS (SELECT contig, gene, GREATEST(1, MIN(position) - 1000) AS s, MAX(position) + 1000 AS e FROM plp GROUP BY 1, 2)
SELECT g.variant_id, COUNT(*) AS n FROM genotype g WHERE EXISTS (SELECT 1 FROM sp WHERE sp.contig = g.chromosome AND g.position BETWEEN s AND e) GROUP BY 1""",
)
def interval_calls(lens: Lens) -> DataFrame:
    plp = lens.annotation.filter(F.col("clinvar_significance").contains("red") & F.col("consequence").contains("PROMO"))
    spans = genotypes.merged_intervals(
        plp.select(F.col("chromosome").alias("contig"), "gene", "position"), gap=0
    )
    rows = lens.genotype.withColumnRenamed("chromosome", "contig")
    return genotypes.in_intervals(rows, spans).groupBy("variant_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "interval_pruned_calls",
    """, iv AS (SELECT DISTINCT chromosome AS contig, GREATEST(1, position - 1000) AS s, position + 1000 AS e FROM annotation WHERE position % 70000 = 0),
few AS (SELECT * FROM iv QUALIFY ROW_NUMBER() OVER (ORDER BY contig, s) <= 9),
n AS (SELECT 'few' AS kind, variant_id, person_id, dosage FROM genotype g WHERE EXISTS (SELECT 1 FROM few WHERE contig = g.chromosome AND g.position BETWEEN s AND e)
  UNION ALL SELECT 'many', variant_id, person_id, dosage FROM genotype g WHERE EXISTS (SELECT 1 FROM iv WHERE contig = g.chromosome AND g.position BETWEEN s AND e))
SELECT kind, variant_id, COUNT(*) AS n, SUM(dosage)::BIGINT AS dosage FROM n GROUP BY 1, 2""",
)
def pruned_calls(lens: Lens) -> DataFrame:
    """Stored genotypes read by intervals: few as literal predicates, many by a join on the partition columns."""
    at = F.col("position")
    near = lens.annotation.filter("position % 70000 = 0").select(F.col("chromosome").alias("contig"), F.greatest(F.lit(1), at - 1000).alias("start"), (at + 1000).alias("end"))
    spans = cut_lineage(near)
    path = genotype_store.write_ranges(lens.genotype, intermediate_path(lens.spark, "genotypes"), bin_positions=1_000_000)
    few = spans.orderBy("contig", "start").limit(9)
    read = lambda asked, limit: genotype_store.read_intervals(lens.spark, path, asked, bin_positions=1_000_000, few=limit)
    both = read(few, 64).withColumn("kind", F.lit("few")).unionByName(read(spans, 0).withColumn("kind", F.lit("many")))
    return both.groupBy("kind", "variant_id").agg(F.count(F.lit(1)).alias("n"), F.sum("dosage").cast("long").alias("dosage"))


@query(
    "bucketed_genotypes",
    """SELECT gene, COUNT(*) AS n, SUM(dosage)::BIGINT AS dosage, COUNT(DISTINCT person_id) AS people FROM genotype JOIN annotation USING (variant_id) GROUP BY 1""",
)
def bucketed(lens: Lens) -> DataFrame:
    """Calls and annotation in buckets of the variant: their join moves neither."""
    folder = intermediate_path(lens.spark, "buckets")
    calls = genotype_store.write_bucketed(lens.genotype, "variant_id", 16, f"{folder}/calls")
    sites = genotype_store.write_bucketed(lens.annotation.select("variant_id", "gene"), "variant_id", 16, f"{folder}/sites")
    return calls.join(sites, "variant_id").groupBy("gene").agg(F.count(F.lit(1)).alias("n"), F.sum("dosage").cast("long").alias("dosage"), F.count_distinct("person_id").alias("people"))


@query("site_intervals", "SELECT DISTINCT chromosome || ':' || GREATEST(1, position - 5) || '-' || (position + 5) AS interval FROM annotation")
def sites(lens: Lens) -> DataFrame:
    return genotypes.site_intervals(lens.annotation.withColumnRenamed("chromosome", "contig"))


@query(
    "exact_site_extraction",
    """SELECT g.person_id, g.variant_id, a.gene, g.dosage AS n_alt FROM genotype g JOIN annotation a USING (variant_id)
SEMI JOIN (SELECT person_id FROM person WHERE has_wgs = 1) w USING (person_id) WHERE contains(a.clinvar_significance, 'red')""",
)
def extraction(lens: Lens) -> DataFrame:
    targets = lens.annotation.filter(F.col("clinvar_significance").contains("red")).select(
        "variant_id", "gene", F.col("chromosome").alias("contig"), "position", F.lit("R").alias("ref"), F.lit("A").alias("alt")
    )
    calls = lens.genotype.select(
        "person_id", F.col("chromosome").alias("contig"), "position", F.lit("R").alias("ref"), F.lit("A").alias("alt"),
        F.col("dosage").alias("n_alt"),
    )
    return genotypes.exact_sites(calls, targets, lens.person.filter("has_wgs = 1")).select(
        "person_id", "variant_id", "gene", "n_alt"
    )


@query(
    "call_collapse",
    """, dup AS (SELECT person_id, variant_id, dosage, 'legacy' AS callset FROM genotype UNION ALL
  SELECT person_id, variant_id, 1, 'exact' FROM genotype WHERE ft = 'PASS')
SELECT person_id, variant_id, variant_id AS label, MAX(dosage) AS dosage, string_agg(DISTINCT callset, ',' ORDER BY callset) AS callset FROM dup GROUP BY 1, 2, 3""",
)
def collapse(lens: Lens) -> DataFrame:
    g = lens.genotype.select("person_id", "variant_id", F.col("variant_id").alias("label"), F.col("dosage").cast("long").alias("dosage"), "ft")
    dup = g.withColumn("callset", F.lit("legacy")).unionByName(
        g.filter("ft = 'PASS'").withColumn("dosage", F.lit(1).cast("long")).withColumn("callset", F.lit("exact"))
    )
    return genotypes.collapse_calls(dup, ["label"])


@query(
    "panel_person_summary",
    SAMPLE_SQL + MASK_SQL
    + "SELECT person_id, COUNT(DISTINCT variant_id) AS n_plp_variants, COUNT(DISTINCT gene) AS n_plp_genes, MAX(dosage) AS max_dosage FROM masked WHERE mask_primary GROUP BY 1",
)
def person_summary(lens: Lens) -> DataFrame:
    return genotypes.panel_person_summary(masked_calls(lens).filter("mask_primary"))


COMPARISON_SQL = """
, cmp AS (SELECT 'broad' AS comparison, person_id, broad_case AS outcome FROM sampl
  UNION ALL SELECT 'definite', person_id, definite_case FROM sampl WHERE definite_case = 1 OR eligible_control = 1
  UNION ALL SELECT 'ancestry_' || lower(ancestry_pred), person_id, broad_case FROM sampl
    WHERE ancestry_pred IN (SELECT ancestry_pred FROM sampl GROUP BY 1 HAVING COUNT(DISTINCT broad_case) = 2)),
ctot AS (SELECT comparison, COUNT(*) FILTER (WHERE outcome = 1) AS n_cases, COUNT(*) FILTER (WHERE outcome = 0) AS n_controls FROM cmp GROUP BY 1)
"""


@query(
    "comparison_sets",
    SAMPLE_SQL + COMPARISON_SQL + "SELECT * FROM ctot",
)
def comparison_sets(lens: Lens) -> DataFrame:
    return (
        association.comparison_samples(sample(lens))
        .groupBy("comparison")
        .agg(F.count_if(F.col("outcome") == 1).alias("n_cases"), F.count_if(F.col("outcome") == 0).alias("n_controls"))
    )


def _bh_sql(source: str, p: str, out: str, partition: str = "") -> str:
    part = f"PARTITION BY {partition} " if partition else ""
    return f"""
, {out}_r AS (SELECT *, COUNT(*) OVER ({part.strip()}) AS bh_n, ROW_NUMBER() OVER ({part}ORDER BY {p} NULLS LAST) AS bh_rk FROM {source}),
{out}_t AS (SELECT *, CASE WHEN {p} IS NOT NULL THEN LEAST(1.0::DOUBLE, MIN({p} * bh_n / bh_rk) OVER ({part}ORDER BY bh_rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) END AS {out} FROM {out}_r)
"""


CARRIER_SQL = (
    SAMPLE_SQL
    + COMPARISON_SQL
    + """, car AS (SELECT comparison, variant_id, COUNT(*) FILTER (WHERE outcome = 1) AS a, COUNT(*) FILTER (WHERE outcome = 0) AS c
  FROM called JOIN cmp USING (person_id) WHERE n_alt >= 1 GROUP BY 1, 2),
tested AS (SELECT DISTINCT variant_id FROM called WHERE n_alt >= 1),
cells AS (SELECT comparison || '|' || t.variant_id AS id, comparison, t.variant_id, COALESCE(a, 0) AS a, n_cases - COALESCE(a, 0) AS b, COALESCE(c, 0) AS c,
  n_controls - COALESCE(c, 0) AS d, n_cases, n_controls FROM tested t CROSS JOIN ctot LEFT JOIN car USING (comparison, variant_id))
"""
    + fisher_sql("cells")
    + ", carrier AS (SELECT cells.*, fish.p AS fisher_p FROM cells JOIN fish USING (id))"
)


def _carrier(lens: Lens) -> DataFrame:
    exposures = called(lens).filter("n_alt > 0").select("person_id", "variant_id", F.col("n_alt").alias("dosage"))
    return association.carrier_tests(
        exposures, association.comparison_samples(sample(lens)), ["variant_id"], ["comparison"]
    )


@query(
    "variant_carrier_tests",
    CARRIER_SQL
    + _bh_sql("carrier", "fisher_p", "fdr_q", "comparison")
    + """SELECT comparison, variant_id, a AS case_carriers, b AS case_noncarriers, c AS control_carriers, d AS control_noncarriers,
  ROUND(CAST(a AS DOUBLE) / NULLIF(n_cases, 0), 6) AS case_carrier_fraction, ROUND(fisher_p, 6) AS fisher_p, ROUND(fdr_q, 6) AS fdr_q FROM fdr_q_t""",
)
def carrier(lens: Lens) -> DataFrame:
    tests = _carrier(lens)
    return benjamini_hochberg(tests, "fisher_p", "fdr_q", ["variant_id"], ["comparison"]).select(
        "comparison", "variant_id", "case_carriers", "case_noncarriers", "control_carriers", "control_noncarriers",
        "case_carrier_fraction", "fisher_p", "fdr_q",
    )


BURDEN_SQL = (
    SAMPLE_SQL
    + MASK_SQL
    + """, ml AS (SELECT 'primary' AS mask, gene, person_id, variant_id, dosage FROM masked WHERE mask_primary
  UNION ALL SELECT 'pLoF', gene, person_id, variant_id, dosage FROM masked WHERE mask_plof
  UNION ALL SELECT 'pLoF_or_REVEL_0_8', gene, person_id, variant_id, dosage FROM masked WHERE mask_plof_or_revel),
mk AS (SELECT ml.*, outcome FROM ml JOIN sampl USING (person_id)),
nt AS (SELECT COUNT(*) FILTER (WHERE outcome = 1) AS n1, COUNT(*) FILTER (WHERE outcome = 0) AS n0 FROM sampl),
cells AS (SELECT mask || '|' || gene AS id, mask, gene, COUNT(DISTINCT variant_id) AS n_variants_in_mask,
  COUNT(DISTINCT CASE WHEN outcome = 1 THEN person_id END) AS a, MAX(n1) - COUNT(DISTINCT CASE WHEN outcome = 1 THEN person_id END) AS b,
  COUNT(DISTINCT CASE WHEN outcome = 0 THEN person_id END) AS c, MAX(n0) - COUNT(DISTINCT CASE WHEN outcome = 0 THEN person_id END) AS d
  FROM mk, nt GROUP BY mask, gene)
"""
    + fisher_sql("cells")
)
BURDEN_MASKS = ["primary", "pLoF", "pLoF_or_REVEL_0_8"]


def _burden_rows(lens: Lens) -> DataFrame:
    return association.burden_exposures(masked_calls(lens), BURDEN_MASKS, genotypes.MASK_COLUMNS)


@query(
    "gene_burden_carriers",
    BURDEN_SQL
    + """SELECT mask, gene, n_variants_in_mask, a AS case_carriers, b AS case_noncarriers, c AS control_carriers, d AS control_noncarriers,
  ROUND(p, 6) AS fisher_p FROM cells JOIN fish USING (id)""",
)
def burden_counts(lens: Lens) -> DataFrame:
    people = sample(lens)
    kept = _burden_rows(lens).join(people.select("person_id"), "person_id", "left_semi")
    n = kept.groupBy("mask", "gene").agg(F.count_distinct("variant_id").alias("n_variants_in_mask"))
    exposures = genotypes.max_dosage(kept, "mask", "gene")
    return n.join(association.carrier_tests(exposures, people, ["mask", "gene"]), ["mask", "gene"]).select(
        "mask", "gene", "n_variants_in_mask", "case_carriers", "case_noncarriers", "control_carriers",
        "control_noncarriers", "fisher_p",
    )


# complete cases of the covariates, one row for each person
DESIGN_SQL = ", dsg AS (SELECT person_id, outcome, pc1, pc2, is_female FROM sampl WHERE outcome IS NOT NULL AND pc1 IS NOT NULL AND pc2 IS NOT NULL AND is_female IS NOT NULL)\n"


def _wald_sql(fit: str, keys: str, at: int) -> str:
    """CTE ``wald``: beta, se and two-sided p of coefficient ``at``, the last; NULL where the fit did not converge."""
    return f"""
, wz AS (SELECT {keys}, n AS n_samples, CASE WHEN ok THEN b{at} END AS beta, CASE WHEN ok THEN sqrt(1 / schur) END AS se FROM {fit}),
wald AS (SELECT *, {tail_sql('(beta / se)')} AS regression_p FROM wz)
"""


@query(
    "gene_burden_regression",
    BURDEN_SQL
    + DESIGN_SQL
    + """, bx AS (SELECT mask, gene, person_id, MAX(dosage) AS x FROM mk GROUP BY ALL),
brows AS (SELECT c.mask, c.gene, 1.0::DOUBLE AS x0, pc1 AS x1, pc2 AS x2, is_female AS x3, COALESCE(x, 0)::DOUBLE AS x4, outcome AS y
  FROM cells c CROSS JOIN dsg d LEFT JOIN bx ON bx.mask = c.mask AND bx.gene = c.gene AND bx.person_id = d.person_id)
"""
    + newton_sql("bfit", "brows", ["mask", "gene"], 5)
    + _wald_sql("bfit", "mask, gene", 4)
    + _bh_sql("wald", "regression_p", "fdr_q")
    + """SELECT t.mask, t.gene, n_variants_in_mask, ROUND(beta, 4) AS beta, ROUND(se, 4) AS se, ROUND(exp(beta), 4) AS odds_ratio, ROUND(regression_p, 4) AS regression_p,
  ROUND(fdr_q, 4) AS fdr_q, n_samples FROM fdr_q_t t JOIN cells c ON c.mask = t.mask AND c.gene = t.gene""",
    decimals=4,
)
def burden(lens: Lens) -> DataFrame:
    return association.gene_burden(_burden_rows(lens), sample(lens), COVARIATES).select(
        "mask", "gene", "n_variants_in_mask", "beta", "se", "odds_ratio", "regression_p", "fdr_q", "n_samples"
    )


@query(
    "carrier_logistic_closed_form",
    BURDEN_SQL
    + """SELECT mask, gene, CASE WHEN LEAST(a, b, c, d) > 0 THEN ROUND(ln((CAST(a AS DOUBLE) * d) / (CAST(b AS DOUBLE) * c)), 5) END AS beta,
  CASE WHEN LEAST(a, b, c, d) > 0 THEN ROUND(sqrt(1.0::DOUBLE / a + 1.0::DOUBLE / b + 1.0::DOUBLE / c + 1.0::DOUBLE / d), 5) END AS se FROM cells""",
    decimals=5,
)
def closed_form(lens: Lens) -> DataFrame:
    """Regression on a 0/1 exposure without covariates has a closed form, which the oracle states."""
    people = sample(lens)
    kept = _burden_rows(lens).join(people.select("person_id"), "person_id", "left_semi")
    binary = kept.select("mask", "gene", "person_id", F.lit(1.0).alias("dosage")).distinct()
    return association.logistic_per_unit(binary, people, ["mask", "gene"], []).select("mask", "gene", "beta", "se")


def _gwas(lens: Lens) -> DataFrame:
    people = sample(lens)
    calls = sample_calls(lens, people)
    passing = flagged(lens, people, calls).filter("biallelic and qc_pass")
    tested = passing.select("variant_id", "maf", "mac", "call_rate", "hwe_control_p", "hwe_case_p").join(
        lens.annotation.select("variant_id", "chromosome", "position", "gene"), "variant_id"
    )
    tested = cut_lineage(tested)
    exposures = genotypes.mean_imputed(calls.join(tested.select("variant_id"), "variant_id", "left_semi"), people)
    fits = association.logistic_per_unit(exposures, people, ["variant_id"], COVARIATES, panel=tested)
    return tested.join(fits, "variant_id")


GWAS_SQL = (
    STATS_SQL
    + DESIGN_SQL
    + f""", tst AS (SELECT a.variant_id, a.chromosome, a.position, a.gene, maf, mac, CAST(ac AS DOUBLE) / n_called AS mean_dosage FROM annotation a JOIN stats USING (variant_id)
  WHERE biallelic AND maf >= {QC['min_maf']} AND mac >= {QC['min_mac']} AND call_rate >= {QC['min_call_rate']} AND hwe_control_p >= {QC['min_hwe_p']}),
gx AS (SELECT variant_id, person_id, COALESCE(CAST(n_alt AS DOUBLE), mean_dosage) AS x FROM called JOIN tst USING (variant_id)),
grows AS (SELECT t.variant_id, 1.0::DOUBLE AS x0, pc1 AS x1, pc2 AS x2, is_female AS x3, COALESCE(x, 0)::DOUBLE AS x4, outcome AS y
  FROM tst t CROSS JOIN dsg d LEFT JOIN gx ON gx.variant_id = t.variant_id AND gx.person_id = d.person_id)
"""
    + newton_sql("gfit", "grows", ["variant_id"], 5)
    + _wald_sql("gfit", "variant_id", 4)
)


@query(
    "matrix_gwas",
    GWAS_SQL
    + _bh_sql("wald", "regression_p", "fdr_q")
    + """SELECT variant_id, chromosome, position, gene, ROUND(maf, 4) AS maf, CAST(mac AS BIGINT) AS mac, ROUND(beta, 4) AS beta, ROUND(se, 4) AS se, ROUND(exp(beta), 4) AS odds_ratio,
  ROUND(regression_p, 4) AS regression_p, ROUND(fdr_q, 4) AS fdr_q, ROUND(-log10(GREATEST(regression_p, 1e-300)), 4) AS minus_log10_p, n_samples FROM fdr_q_t JOIN tst USING (variant_id)""",
    decimals=4,
)
def gwas(lens: Lens) -> DataFrame:
    return association.gwas_postprocess(_gwas(lens)).select(
        "variant_id", "chromosome", "position", "gene", "maf", "mac", "beta", "se", "odds_ratio", "regression_p",
        "fdr_q", "minus_log10_p", "n_samples",
    )


@query(
    "genomic_control_lambda",
    GWAS_SQL + "SELECT ROUND(quantile_cont(beta * beta / (se * se), 0.5) / 0.4549364, 5) AS lambda_gc FROM wald WHERE regression_p > 0 AND regression_p <= 1",
    decimals=5,
)
def lambda_gc(lens: Lens) -> DataFrame:
    return association.genomic_control(_gwas(lens))


PRIOR_SQL = (
    SAMPLE_SQL
    + COMPARISON_SQL
    + """, pan AS (SELECT variant_id, revel >= 0.5 AS hom FROM annotation WHERE contains(clinvar_significance, 'red') AND contains(consequence, 'PROMO')),
px AS (SELECT variant_id, person_id, CASE WHEN hom THEN CAST(n_alt >= 2 AS DOUBLE) ELSE CAST(n_alt AS DOUBLE) END AS x FROM called JOIN pan USING (variant_id) WHERE n_alt > 0),
pc AS (SELECT comparison, variant_id, COUNT(*) FILTER (WHERE outcome = 1) AS a, COUNT(*) FILTER (WHERE outcome = 0) AS c FROM px JOIN cmp USING (person_id) WHERE x > 0 GROUP BY 1, 2),
cells AS (SELECT ctot.comparison || '|' || pan.variant_id AS id, ctot.comparison, pan.variant_id, COALESCE(a, 0) AS a, n_cases - COALESCE(a, 0) AS b, COALESCE(c, 0) AS c,
  n_controls - COALESCE(c, 0) AS d FROM pan CROSS JOIN ctot LEFT JOIN pc ON pc.comparison = ctot.comparison AND pc.variant_id = pan.variant_id)
"""
    + fisher_sql("cells")
    + """, prows AS (SELECT cmp.comparison, pan.variant_id, 1.0::DOUBLE AS x0, s.pc1 AS x1, COALESCE(x, 0)::DOUBLE AS x2, cmp.outcome AS y
  FROM pan CROSS JOIN cmp JOIN sampl s ON s.person_id = cmp.person_id LEFT JOIN px ON px.variant_id = pan.variant_id AND px.person_id = cmp.person_id WHERE pc1 IS NOT NULL)
"""
    + newton_sql("pfit", "prows", ["comparison", "variant_id"], 3)
    + _wald_sql("pfit", "comparison, variant_id", 2)
    + ", both_p AS (SELECT c.comparison, c.variant_id, a, c, f.p AS fisher_p, beta, regression_p FROM cells c JOIN fish f USING (id) JOIN wald w ON w.comparison = c.comparison AND w.variant_id = c.variant_id)"
    + _bh_sql("both_p", "fisher_p", "fdr_q", "comparison")
    + _bh_sql("fdr_q_t", "regression_p", "rq", "comparison").replace("COUNT(*) OVER (PARTITION BY comparison) AS bh_n", "COUNT(*) OVER (PARTITION BY comparison) AS bh_m").replace("NULLS LAST) AS bh_rk", "NULLS LAST) AS bh_k").replace("* bh_n / bh_rk", "* bh_m / bh_k").replace("ORDER BY bh_rk ROWS", "ORDER BY bh_k ROWS")
)


@query(
    "prior_variant_association",
    PRIOR_SQL
    + """SELECT comparison, variant_id, a AS case_carriers, c AS control_carriers, ROUND(fisher_p, 4) AS fisher_p, ROUND(fdr_q, 4) AS fdr_q, ROUND(beta, 4) AS beta,
  ROUND(regression_p, 4) AS regression_p, ROUND(rq, 4) AS regression_fdr_q FROM rq_t""",
    decimals=4,
)
def prior_variants(lens: Lens) -> DataFrame:
    """A-priori panel: P/LP-term variants, every comparison set, additive or homozygous model."""
    panel = lens.annotation.filter(F.col("clinvar_significance").contains("red") & F.col("consequence").contains("PROMO")).select(
        "variant_id",
        F.when(F.col("revel") >= 0.5, "hom_alt_vs_rest").otherwise("carrier_vs_noncarrier").alias("exact_test_model"),
    )
    exposures = association.apply_exposure_model(
        called(lens).filter("n_alt > 0").select("person_id", "variant_id", F.col("n_alt").alias("dosage")), panel
    )
    return association.panel_association(
        exposures, association.comparison_samples(sample(lens)), ["variant_id"], ["pc1"], panel=panel.select("variant_id")
    ).select(
        "comparison", "variant_id", "case_carriers", "control_carriers", "fisher_p", "fdr_q", "beta", "regression_p",
        "regression_fdr_q",
    )


def _positioned(lens: Lens) -> DataFrame:
    """Broad-comparison Fisher p per variant, rounded so both engines order ties alike."""
    tests = _carrier(lens).filter("comparison = 'broad'").select("variant_id", F.round("fisher_p", 9).alias("regression_p"))
    return tests.join(lens.annotation.select("variant_id", "chromosome", "position"), "variant_id")


POSITIONED_SQL = (
    CARRIER_SQL
    + ", pos AS (SELECT variant_id, chromosome, position, ROUND(fisher_p, 9) AS p FROM carrier JOIN annotation USING (variant_id) WHERE comparison = 'broad')"
)


@query(
    "lead_hits",
    POSITIONED_SQL
    + """, o AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER (PARTITION BY chromosome ORDER BY p, variant_id) AS rk FROM pos),
rec(chromosome, rk, kept, variant_id, is_lead) AS (
  SELECT chromosome, rk, [position], variant_id, TRUE FROM o WHERE rk = 1
  UNION ALL
  SELECT o.chromosome, o.rk,
    CASE WHEN len(list_filter(rec.kept, lambda x: abs(x - o.position) <= 1000000)) = 0 THEN list_append(rec.kept, o.position) ELSE rec.kept END,
    o.variant_id, len(list_filter(rec.kept, lambda x: abs(x - o.position) <= 1000000)) = 0
  FROM rec JOIN o ON o.chromosome = rec.chromosome AND o.rk = rec.rk + 1)
SELECT r.variant_id, r.chromosome, o.position, o.p AS regression_p FROM rec r JOIN o USING (variant_id) WHERE is_lead""",
    decimals=9,
)
def lead(lens: Lens) -> DataFrame:
    return leads.lead_hits(_positioned(lens), 1_000_000).select("variant_id", "chromosome", "position", "regression_p")


@query(
    "qq_points",
    POSITIONED_SQL
    + """SELECT variant_id, ROW_NUMBER() OVER (ORDER BY p, variant_id) AS rank, ROUND(-log10(GREATEST(p, 1e-300)), 6) + 0.0::DOUBLE AS observed,
  ROUND(-log10(ROW_NUMBER() OVER (ORDER BY p, variant_id) / CAST((SELECT COUNT(*) FROM pos) + 1 AS DOUBLE)), 6) AS expected FROM pos WHERE p > 0 AND p <= 1""",
)
def qq(lens: Lens) -> DataFrame:
    return association.qq_points(_positioned(lens))


@query(
    "manhattan_points",
    POSITIONED_SQL
    + """, ends AS (SELECT CAST(chromosome AS INT) AS chr, MAX(position) AS e FROM pos GROUP BY 1),
offs AS (SELECT chr, COALESCE(SUM(e + 1000000) OVER (ORDER BY chr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM ends)
SELECT variant_id, chromosome, position, CAST(position + off AS BIGINT) AS x, ROUND(-log10(GREATEST(p, 1e-300)), 6) + 0.0::DOUBLE AS y
FROM pos JOIN offs ON chr = CAST(chromosome AS INT)""",
)
def manhattan(lens: Lens) -> DataFrame:
    return association.manhattan_points(_positioned(lens))


@query(
    "chromosome_subset",
    SAMPLE_SQL
    + """, mf AS (SELECT variant_id, chromosome, position, CASE WHEN revel >= 0.5 THEN max_af * 25 END AS maf FROM annotation)
SELECT g.person_id, g.variant_id, g.dosage, ROUND(mf.maf, 6) AS maf FROM genotype g JOIN mf USING (variant_id) SEMI JOIN sampl USING (person_id)
WHERE g.chromosome = '7' AND (maf IS NULL OR maf >= 0.02)""",
)
def chromosome_subset(lens: Lens) -> DataFrame:
    table = lens.annotation.select(
        "variant_id", "chromosome", "position", F.when(F.col("revel") >= 0.5, F.col("max_af") * 25).alias("maf")
    )
    entries, _ = genotypes.gwas_subset(lens.genotype, sample(lens), table, autosomes(["chr7"])[0], 0.02)
    return entries.select("person_id", "variant_id", "dosage", "maf")
