"""Genotype and annotation operators on long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from casewright.functions.distributions import hwe_p
from casewright.functions.scalars import interval_text, lenient_double, variant_key
from casewright.operators.ranking import global_scan
from casewright.session import cut_lineage
from casewright.operators.skew import salted_lookup

BASES = ("A", "C", "G", "T")
PASS_FILTERS = ("", ".", "PASS")


# Genotype calls ----------------------------------------------------------------------------------

def n_alt_alleles(gt: Column) -> Column:
    """Number of non-reference alleles of a GT array; NULL for a missing call."""
    return F.when(
        gt.isNotNull() & ~F.exists(gt, lambda a: a.isNull()),
        F.size(F.filter(gt, lambda a: a > 0)),
    )


def local_to_global(lgt: Column, la: Column) -> Column:
    """Local-allele GT with its allele map → global GT."""
    return F.transform(lgt, lambda i: F.get(la, i))


def passed_call(gt: Column, ft: Column) -> Column:
    """Keep a call whose filter is absent or passing; otherwise NULL."""
    return F.when(ft.isNull() | ft.isin(*PASS_FILTERS), gt)


def is_biallelic_snp(alleles: Column) -> Column:
    first, second = F.get(alleles, F.lit(0)), F.get(alleles, F.lit(1))
    return F.coalesce((F.size(alleles) == 2) & first.isin(*BASES) & second.isin(*BASES), F.lit(False))


def split_multiallelic(calls: DataFrame) -> DataFrame:
    """One row per alternate allele; the genotype is recoded to 0/1 for that allele."""
    return (
        calls.withColumn("_pair", F.explode(F.transform(F.slice("alleles", 2, F.size("alleles")), lambda a, i: F.struct(i.alias("i"), a.alias("alt")))))
        .withColumns(
            {
                "ref": F.get("alleles", F.lit(0)),
                "alt": F.col("_pair.alt"),
                "n_alt": F.when(
                    F.col("gt").isNotNull(),
                    F.size(F.filter("gt", lambda g: g == F.col("_pair.i") + 1)),
                ),
            }
        )
        .drop("_pair")
    )


# Variant QC --------------------------------------------------------------------------------------

def variant_stats(
    genotypes: DataFrame, samples: DataFrame, outcome: str = "analysis_case", dense: bool = False, midp: bool = True, stored: bool = False
) -> DataFrame:
    """Call statistics and control/case Hardy–Weinberg p per variant.

    ``dense``: an absent row is a missing call. Otherwise an absent row is homozygous reference.
    Genotypes need ``variant_id, person_id, n_alt``; a NULL ``n_alt`` is a filtered call. They are written first, unless
    they are a ``stored`` table.
    """
    people = samples.select("person_id", F.col(outcome).cast("int").alias("_y"))
    totals = people.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("_y") == 0).alias("_n0"),
        F.count_if(F.col("_y") == 1).alias("_n1"),
    )
    called = F.col("n_alt").isNotNull()
    per_class = {
        f"_{name}{y}": F.count_if((F.col("_y") == y) & test)
        for y in (0, 1)
        for name, test in {
            "het": F.col("n_alt") == 1,
            "alt": F.col("n_alt") >= 2,
            "ref": F.col("n_alt") == 0,
            "null": ~called,
        }.items()
    }
    agg = (
        # salted: one sample may hold a large share of the calls
        salted_lookup(genotypes.select("variant_id", "person_id", "n_alt"), people, "person_id", "variant_id", stored=stored)
        .groupBy("variant_id")
        .agg(
            F.sum("n_alt").alias("ac"),
            F.count("n_alt").alias("_called"),
            F.count_if(~called).alias("_nulls"),
            *[c.alias(k) for k, c in per_class.items()],
        )
        .crossJoin(F.broadcast(totals))  # one row
    )
    n_called = F.col("_called") if dense else F.col("n_total") - F.col("_nulls")

    def hom_ref(y: int) -> Column:
        if dense:
            return F.col(f"_ref{y}")
        return F.col(f"_n{y}") - F.col(f"_het{y}") - F.col(f"_alt{y}") - F.col(f"_null{y}")

    ac = F.coalesce("ac", F.lit(0)).cast("long")
    stats = agg.select(
        "variant_id",
        ac.alias("ac"),
        n_called.cast("long").alias("n_called"),
        (n_called * 2).cast("long").alias("an"),
        "n_total",
        *[hom_ref(y).alias(f"hom_ref_{y}") for y in (0, 1)],
        *[F.col(f"_{g}{y}").alias(f"{n}_{y}") for y in (0, 1) for g, n in (("het", "het"), ("alt", "hom_alt"))],
    ).withColumns(
        {
            "af": F.when(F.col("an") > 0, F.col("ac") / F.nullif(F.col("an"), F.lit(0))),
            "mac": F.least(F.col("ac"), F.col("an") - F.col("ac")),
            "call_rate": F.when(F.col("n_total") > 0, F.col("n_called") / F.nullif(F.col("n_total"), F.lit(0))),
        }
    )
    return stats.withColumns(
        {
            "maf": F.least(F.col("af"), F.lit(1.0) - F.col("af")),
            "hwe_control_p": hwe_p(F.col("hom_ref_0"), F.col("het_0"), F.col("hom_alt_0"), midp),
            "hwe_case_p": hwe_p(F.col("hom_ref_1"), F.col("het_1"), F.col("hom_alt_1"), midp),
        }
    )


def variant_means(calls: DataFrame, people: DataFrame) -> DataFrame:
    """(variant_id, mean_dosage) of ``people``'s sparse calls: an absent row is dosage 0, a NULL ``n_alt`` is missing.

    The mean is over the people who have a call, those of dosage 0 included; NULL where nobody has one.
    """
    total = people.agg(F.count_distinct("person_id").alias("_n"))
    held = calls.join(people.select("person_id").distinct(), "person_id", "left_semi")
    return (
        held.groupBy("variant_id")
        .agg(F.coalesce(F.sum(F.col("n_alt").cast("double")), F.lit(0.0)).alias("_s"), F.count_if(F.col("n_alt").isNull()).alias("_m"))
        .crossJoin(F.broadcast(total))  # one row
        .select("variant_id", (F.col("_s") / F.nullif(F.col("_n") - F.col("_m"), F.lit(0))).alias("mean_dosage"))
    )


def mean_imputed(calls: DataFrame, people: DataFrame, decimals: int | None = None, means_of: DataFrame | None = None) -> DataFrame:
    """(variant_id, person_id, dosage): ``people``'s calls other than 0, missing ones as the variant's mean, rounded to ``decimals``.

    The mean is that of ``means_of``, a part of the people, where it is given.
    """
    held = calls.join(people.select("person_id").distinct(), "person_id", "left_semi").select("variant_id", "person_id", F.col("n_alt").cast("double").alias("_x"))
    mean = F.coalesce(F.col("mean_dosage"), F.lit(0.0))
    mean = mean if decimals is None else F.round(mean, decimals)
    known = held.filter("_x <> 0").select("variant_id", "person_id", F.col("_x").alias("dosage"))
    missing = salted_lookup(held.filter("_x is null"), variant_means(calls, people if means_of is None else means_of), "variant_id", "person_id")
    return known.unionByName(missing.select("variant_id", "person_id", mean.alias("dosage")).filter("dosage <> 0"))


def qc_flags(
    stats: DataFrame,
    min_maf: float = 0.05,
    min_mac: int = 20,
    min_call_rate: float = 0.98,
    min_hwe_p: float = 1e-6,
    hwe_mode: str = "filter",
) -> DataFrame:
    """Cumulative pass columns: MAF → MAC → call rate → control HWE; ``report-only`` leaves HWE out of ``qc_pass``."""
    if hwe_mode not in ("filter", "report-only"):
        raise ValueError(f"unknown HWE mode: {hwe_mode}")
    ok = lambda test: F.coalesce(test, F.lit(False))
    maf = ok(F.col("maf") >= min_maf)
    mac = maf & ok(F.col("mac") >= min_mac)
    call = mac & ok(F.col("call_rate") >= min_call_rate)
    hwe = call & ok(F.col("hwe_control_p") >= min_hwe_p)
    return stats.withColumns(
        {
            "pass_maf": maf,
            "pass_mac": mac,
            "pass_call_rate": call,
            "pass_hwe": hwe,
            "qc_pass": hwe if hwe_mode == "filter" else call,
        }
    )


_FUNNEL = ["biallelic", "pass_maf", "pass_mac", "pass_call_rate", "pass_hwe"]


def _funnel_counts(count: bool = True) -> list[Column]:
    """How many rows there are, and how many pass each step; NULLs with ``count=False``."""
    ok = lambda c: F.coalesce(F.col(c), F.lit(False))
    total = (lambda c: F.count_if(c)) if count else (lambda c: F.lit(None).cast("long"))
    passed = {c: ok(c) if c == "biallelic" else ok("biallelic") & ok(c) for c in [*_FUNNEL, "qc_pass"]}
    return [(F.count(F.lit(1)) if count else F.lit(None).cast("long")).alias("_all"), *[total(v).alias(f"_{c}") for c, v in passed.items()]]


def _funnel_steps(hwe_mode: str) -> list[tuple[str, str, str]]:
    """(filter, count before, count after)."""
    names = ["biallelic_snp", "maf", "mac", "call_rate", "control_hwe" if hwe_mode == "filter" else "control_hwe_report_only"]
    steps = [("input", "_all", "_all")]
    for name, c in zip(names, _FUNNEL, strict=True):
        steps.append((name, steps[-1][2], f"_{c}"))
    return steps if hwe_mode == "filter" else [*steps, ("final_qc", "_pass_call_rate", "_qc_pass")]


def qc_funnel(flagged: DataFrame, hwe_mode: str = "filter", count: bool = True) -> DataFrame:
    """(filter, rows_before, rows_after, rows_removed) from one pass; ``count=False`` leaves the counts NULL.

    Input rows carry ``biallelic`` and the cumulative pass columns.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("step"),
                F.lit(n).alias("filter"),
                F.col(b).alias("rows_before"),
                F.col(a).alias("rows_after"),
                (F.col(b) - F.col(a)).alias("rows_removed"),
            )
            for i, (n, b, a) in enumerate(_funnel_steps(hwe_mode))
        ]
    )
    return flagged.agg(*_funnel_counts(count)).select(F.inline(rows))


def stored_with_funnel(flagged: DataFrame, hwe_mode: str = "filter", count: bool = True) -> tuple[DataFrame, DataFrame]:
    """The flagged table, written, and its funnel. The counts ride on that write, so the funnel has no job of its own."""
    spark = flagged.sparkSession
    schema = "step int, filter string, rows_before long, rows_after long, rows_removed long"
    if not count:
        return cut_lineage(flagged), spark.createDataFrame([(i, n, None, None, None) for i, (n, _, _) in enumerate(_funnel_steps(hwe_mode))], schema)
    seen = Observation()
    stored = cut_lineage(flagged.observe(seen, *_funnel_counts()))
    got = seen.get
    return stored, spark.createDataFrame([(i, n, got[b], got[a], got[b] - got[a]) for i, (n, b, a) in enumerate(_funnel_steps(hwe_mode))], schema)


def maf_from_dosage(genotypes: DataFrame, n_people: DataFrame) -> DataFrame:
    """Per variant: mac = Σ max dosage per person; maf = supplied value else mac / 2n. ``n_people`` is one row."""
    supplied = F.min(lenient_double("maf")) if "maf" in genotypes.columns else F.lit(None).cast("double")
    per_person = genotypes.groupBy("variant_id", "person_id").agg(
        F.max(F.coalesce(lenient_double("dosage"), F.lit(0.0))).alias("_d"), supplied.alias("_maf")
    )
    return (
        per_person.groupBy("variant_id")
        .agg(F.sum("_d").alias("minor_allele_count"), F.min("_maf").alias("_maf"))
        .crossJoin(F.broadcast(n_people))  # one row
        .select(
            "variant_id",
            "minor_allele_count",
            F.coalesce("_maf", F.col("minor_allele_count") / (2.0 * F.greatest(F.col("n_people"), F.lit(1)))).alias("maf"),
        )
    )


# Annotation --------------------------------------------------------------------------------------

def variant_masks(
    df: DataFrame,
    clinvar_terms: Sequence[str],
    plof_terms: Sequence[str],
    revel_min: float = 0.8,
    max_af: float = 0.001,
) -> DataFrame:
    """P/LP, pLoF, REVEL and frequency tests and the four masks built from them.

    Terms are case-insensitive substrings, so ``Pathogenic`` also matches "Likely pathogenic" and
    "Conflicting … pathogenicity"; that is the documented behaviour.
    """

    def has_term(column: str, terms: Sequence[str]) -> Column:
        if column not in df.columns:
            return F.lit(False)
        text = F.lower(F.col(column).cast("string"))
        out = F.lit(False)
        for t in terms:
            out = out | F.coalesce(text.contains(t.lower()), F.lit(False))
        return out

    number = lambda c: lenient_double(c) if c in df.columns else F.lit(None).cast("double")
    return df.withColumns(
        {
            "is_clinvar_plp": has_term("clinvar_significance", clinvar_terms),
            "is_plof": has_term("consequence", plof_terms),
            "is_revel_high": F.coalesce(number("revel") >= revel_min, F.lit(False)),
            "passes_af": F.coalesce(number("max_af") <= max_af, F.lit(True)),
        }
    ).withColumns(
        {
            "mask_primary": F.col("passes_af") & (F.col("is_clinvar_plp") | F.col("is_plof") | F.col("is_revel_high")),
            "mask_plof": F.col("passes_af") & F.col("is_plof"),
            "mask_clinvar_plp": F.col("passes_af") & F.col("is_clinvar_plp"),
            "mask_plof_or_revel": F.col("passes_af") & (F.col("is_plof") | F.col("is_revel_high")),
        }
    )


# Public mask names → mask columns; an unknown name means the primary mask.
MASK_COLUMNS = {
    "primary": "mask_primary",
    "pLoF": "mask_plof",
    "ClinVar_PLP": "mask_clinvar_plp",
    "pLoF_or_REVEL_0_8": "mask_plof_or_revel",
}


# Transcript-annotation input columns, all read as text.
ANNOTATION_COLUMNS = (
    "vid", "contig", "position", "ref_allele", "alt_allele", "gene_symbol", "consequence", "revel",
    "gnomad_max_af", "gvs_max_af", "gvs_all_af", "clinvar_classification", "aa_change", "dbsnp_rsid",
)
REQUIRED_ANNOTATION_COLUMNS = ("contig", "position", "ref_allele", "alt_allele", "gene_symbol")


def annotation_candidates(raw: DataFrame, genes: Sequence[str] | DataFrame) -> DataFrame:
    """Known columns only, restricted to the gene set before any other work."""
    missing = [c for c in REQUIRED_ANNOTATION_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"missing annotation columns: {', '.join(missing)}")
    known = raw.select(
        *[
            (F.col(c).cast("string") if c in raw.columns else F.lit(None).cast("string")).alias(c)
            for c in ANNOTATION_COLUMNS
        ]
    )
    if isinstance(genes, DataFrame):
        return known.join(genes.select(F.col("gene").alias("gene_symbol")).distinct(), "gene_symbol", "left_semi")
    return known.filter(F.col("gene_symbol").isin(*genes))


def _unique_text(c: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(F.nullif(F.trim(F.col(c)), F.lit("")))), ";")


def collapse_transcripts(rows: DataFrame) -> DataFrame:
    """One row per (variant, gene): sorted distinct texts joined by ``;``, numeric maxima, row-max of the AFs."""
    blank_vid = F.coalesce(F.trim("vid"), F.lit("")) == ""
    position = F.col("position").try_cast("double").try_cast("long")
    usable = rows.filter(F.coalesce(F.trim("gene_symbol"), F.lit("")) != "").filter(
        position.isNotNull() & F.col("contig").isNotNull() & F.col("ref_allele").isNotNull() & F.col("alt_allele").isNotNull()
    )
    keyed = usable.select(
        F.when(blank_vid, variant_key("contig", position, "ref_allele", "alt_allele"))
        .otherwise(F.regexp_replace(F.trim("vid"), "chr", ""))
        .alias("variant_id"),
        F.col("gene_symbol").alias("gene"),
        "contig",
        position.alias("position"),
        "ref_allele",
        "alt_allele",
        F.col("clinvar_classification").alias("clinvar_significance"),
        "consequence",
        lenient_double("revel").alias("revel"),
        F.greatest(*[lenient_double(c) for c in ("gnomad_max_af", "gvs_max_af", "gvs_all_af")]).alias("max_af"),
        "aa_change",
        "dbsnp_rsid",
    )
    return keyed.groupBy("variant_id", "gene").agg(
        *[F.min(c).alias(c) for c in ("contig", "position", "ref_allele", "alt_allele")],
        *[_unique_text(c).alias(c) for c in ("clinvar_significance", "consequence")],
        F.max("revel").alias("revel"),
        F.max("max_af").alias("max_af"),
        *[_unique_text(c).alias(c) for c in ("aa_change", "dbsnp_rsid")],
    )


def candidate_variants(raw: DataFrame, genes: Sequence[str] | DataFrame, clinvar_terms: Sequence[str], plof_terms: Sequence[str], **limits) -> DataFrame:
    """Gene filter → transcript collapse → masks → primary mask only."""
    collapsed = collapse_transcripts(annotation_candidates(raw, genes))
    return variant_masks(collapsed, clinvar_terms, plof_terms, **limits).filter("mask_primary")


# Intervals ---------------------------------------------------------------------------------------

def merged_intervals(annotations: DataFrame, pad: int = 1000, gap: int = 50_000) -> DataFrame:
    """Gene spans, padded (floor 1) and merged per contig when at most ``gap`` apart."""
    keys = ["contig", "gene"] if "gene" in annotations.columns else ["contig"]
    spans = (
        annotations.filter(F.col("contig").isNotNull() & F.col("position").isNotNull())
        .groupBy(*keys)
        .agg(F.min("position").alias("_lo"), F.max("position").alias("_hi"))
        .select("contig", F.greatest(F.lit(1), F.col("_lo") - pad).alias("start"), (F.col("_hi") + pad).alias("end"))
        .groupBy("contig", "start")
        .agg(F.max("end").alias("end"))
    )
    reach = global_scan(spans, [F.col("start")], {"_reach": (F.col("end"), "max")}, ["contig"], exclusive=True)
    opened = reach.withColumn(
        "_new", (F.col("_reach").isNull() | (F.col("start") > F.col("_reach") + gap)).cast("int")
    )
    island = global_scan(opened, [F.col("start")], {"_island": (F.col("_new"), "sum")}, ["contig"])
    return (
        island.groupBy("contig", "_island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select("contig", "start", "end", interval_text(F.col("contig"), F.col("start"), F.col("end")).alias("interval"))
    )


def site_intervals(targets: DataFrame, pad: int = 5) -> DataFrame:
    start = F.greatest(F.lit(1), F.col("position") - pad)
    return targets.select(interval_text(F.col("contig"), start, F.col("position") + pad).alias("interval")).distinct()


def in_intervals(df: DataFrame, intervals: DataFrame, bin_width: int = 1_000_000) -> DataFrame:
    """Rows whose position lies in any interval: intervals are exploded to bins, giving an equi-join key.

    Merged intervals never overlap, so a row meets at most one and a semi join keeps it once.
    """
    bins = intervals.select(
        "contig",
        "start",
        "end",
        F.explode(F.sequence(F.floor(F.col("start") / bin_width), F.floor(F.col("end") / bin_width))).alias("_bin"),
    )
    rows = df.withColumn("_bin", F.floor(F.col("position") / bin_width))
    on = (
        (F.col("r.contig") == F.col("i.contig"))
        & (F.col("r._bin") == F.col("i._bin"))
        & F.col("r.position").between(F.col("i.start"), F.col("i.end"))
    )
    return rows.alias("r").join(bins.alias("i"), on, "left_semi").drop("_bin")


# Extraction and collapse -------------------------------------------------------------------------

def exact_sites(genotypes: DataFrame, targets: DataFrame, samples: DataFrame) -> DataFrame:
    """Non-reference calls of the samples at exact (contig, position, ref, alt) targets, with target metadata."""
    calls = genotypes.join(samples.select("person_id").distinct(), "person_id", "left_semi")
    return calls.filter(F.col("n_alt") > 0).join(
        targets.dropDuplicates(["contig", "position", "ref", "alt"]), ["contig", "position", "ref", "alt"]
    )


def extraction_stats(calls: DataFrame, samples: DataFrame, targets: DataFrame) -> DataFrame:
    """One row: requested people and variants, people and variants with a call, rows."""
    return (
        calls.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("person_id").alias("people_with_calls"),
            F.count_distinct("variant_id").alias("variants_with_calls"),
        )
        .crossJoin(F.broadcast(samples.agg(F.count_distinct("person_id").alias("people_requested"))))
        .crossJoin(F.broadcast(targets.agg(F.count_distinct("variant_id").alias("variants_requested"))))
    )


def collapse_calls(calls: DataFrame, metadata: Sequence[str]) -> DataFrame:
    """One row per (person, variant): highest dosage, its metadata, sorted distinct callsets."""
    meta = F.struct(*[F.col(c) for c in metadata])
    best = F.max(F.struct(F.col("dosage"), meta.alias("m"))).alias("_best")
    return (
        calls.groupBy("person_id", "variant_id")
        .agg(best, F.array_join(F.array_sort(F.collect_set(F.nullif(F.col("callset"), F.lit("")))), ",").alias("callset"))
        .select("person_id", "variant_id", *[F.col(f"_best.m.{c}").alias(c) for c in metadata], F.col("_best.dosage").alias("dosage"), "callset")
    )


def max_dosage(genotypes: DataFrame, *unit: str) -> DataFrame:
    """Highest dosage per (unit, person); bad dosages count as 0."""
    return genotypes.groupBy(*unit, "person_id").agg(
        F.max(F.coalesce(lenient_double("dosage"), F.lit(0.0))).alias("dosage")
    )


def panel_person_summary(masked: DataFrame) -> DataFrame:
    return masked.groupBy("person_id").agg(
        F.count_distinct("variant_id").alias("n_plp_variants"),
        F.count_distinct("gene").alias("n_plp_genes"),
        F.max("dosage").alias("max_dosage"),
    )


def gwas_subset(
    genotypes: DataFrame, samples: DataFrame, variant_maf: DataFrame, chromosome: str, min_maf: float
) -> tuple[DataFrame, DataFrame]:
    """One chromosome's non-reference entries of the samples for common-enough variants, and its variant table."""
    kept = variant_maf.filter((F.col("chromosome") == chromosome) & (F.col("maf").isNull() | (F.col("maf") >= min_maf)))
    entries = (
        genotypes.filter((F.col("chromosome") == chromosome) & (F.col("dosage") > 0))
        .join(samples.select("person_id").distinct(), "person_id", "left_semi")
        .join(kept.select("variant_id", "maf").dropDuplicates(["variant_id"]), "variant_id")
    )
    return entries, kept.select("variant_id", "chromosome", "position", "maf").dropDuplicates(["variant_id"])
