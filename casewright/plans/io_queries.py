"""Readers, sinks and small column functions over the given tables: written with a sink, read back with a reader."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from casewright.functions.scalars import hash_score, interval_text, parameter_hash, threshold_label, variant_key, vector_elements
from casewright.operators import genotypes, predicates, samples, scores
from casewright.plans.genotype_queries import SAMPLE_SQL, called, sample
from casewright.plans.registry import query
from casewright.session import intermediate_path
from casewright.sources import genetics, tables
from casewright.sources.lens import CLINVAR_TERMS, PLOF_TERMS, Lens

PEOPLE = ["person_id", "sex", "ancestry_pred", "score"]


@query(
    "table_round_trips",
    """SELECT f AS format, person_id, sex, ancestry_pred, score FROM person, (VALUES ('parquet'), ('tsv'), ('tsv.gz'), ('csv')) t(f)""",
)
def round_trips(lens: Lens) -> DataFrame:
    """Each format gives back what it was given; NULL is an empty cell."""
    people = lens.person.select(*PEOPLE)
    base = intermediate_path(lens.spark, "tables")
    out = []
    for suffix in ("parquet", "tsv", "tsv.gz", "csv"):
        path = tables.write_table(people, f"{base}/people.{suffix}")
        back = tables.read_table(lens.spark, path)
        out.append(back.select(F.lit(suffix).alias("format"), "person_id", F.nullif("sex", F.lit("")).alias("sex"), "ancestry_pred", F.col("score").cast("double").alias("score")))
    return reduce(DataFrame.unionByName, out)


@query(
    "delimited_round_trips",
    """SELECT f AS format, person_id, CAST(year_of_birth AS BIGINT) AS year_of_birth FROM person, (VALUES ('space'), ('separate header')) t(f)""",
)
def delimited(lens: Lens) -> DataFrame:
    people = lens.person.select("person_id", F.col("year_of_birth").cast("long").alias("year_of_birth"))
    base = intermediate_path(lens.spark, "tables")
    spaced = tables.read_whitespace(lens.spark, tables.write_space_delimited(people, f"{base}/space", header=True))
    path = tables.write_with_separate_header(people, f"{base}/headed")
    names = lens.spark.read.text(f"{path}/header").first()["value"].split("\t")
    headed = lens.spark.read.option("sep", "\t").csv(f"{path}/parts").toDF(*names)
    number = F.col("year_of_birth").cast("long").alias("year_of_birth")
    return spaced.select(F.lit("space").alias("format"), "person_id", number).unionByName(headed.select(F.lit("separate header").alias("format"), "person_id", number))


@query(
    "ordered_cohort_sink",
    """SELECT person_id, ancestry_pred, ROW_NUMBER() OVER (ORDER BY ancestry_pred, sex NULLS LAST, person_id) AS place FROM person""",
)
def ordered_sink(lens: Lens) -> DataFrame:
    """The parts of an ordered output, read file by file and row by row, follow the order."""
    path = tables.write_table(lens.person.select(*PEOPLE), f"{intermediate_path(lens.spark, 'tables')}/ordered.parquet", order=("ancestry_pred", "sex", "person_id"))
    rows = lens.spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("row"))
    counted = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    before = counted.alias("a").join(counted.alias("b"), F.col("b.file") < F.col("a.file"), "left").groupBy("a.file").agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    placed = rows.join(counted.select("file", "first"), "file").join(before, "file")
    return placed.select("person_id", "ancestry_pred", (F.col("before") + F.col("row") - F.col("first") + 1).alias("place"))


@query(
    "partitioned_genotypes",
    "SELECT chromosome, COUNT(*) AS n, COUNT(DISTINCT person_id) AS people, MIN(position) AS low, MAX(position) AS high, SUM(dosage)::BIGINT AS dosage FROM genotype WHERE chromosome IN ('3', '17') GROUP BY 1",
)
def partitioned(lens: Lens) -> DataFrame:
    """Genotypes written by chromosome and read back; the filter prunes partitions."""
    back = tables.write_genotypes(lens.genotype, intermediate_path(lens.spark, "genotypes"))
    chosen = back.filter(F.col("chromosome").cast("string").isin("3", "17"))
    return chosen.groupBy(F.col("chromosome").cast("string").alias("chromosome")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("person_id").alias("people"), F.min("position").alias("low"), F.max("position").alias("high"), F.sum("dosage").alias("dosage")
    )


@query("cached_result", "SELECT ancestry_pred, 4 * COUNT(*) AS n FROM person GROUP BY 1")
def cached(lens: Lens) -> DataFrame:
    """The second call reads what the first one wrote: its own build would count nobody. The third one finds its input
    changed, by the same people once more, and counts again."""
    base = intermediate_path(lens.spark, "cache")
    people = lens.person.select("person_id", "ancestry_pred")
    people.write.parquet(f"{base}/people")
    read = lambda: lens.spark.read.parquet(f"{base}/people")
    build = lambda rows: rows.groupBy("ancestry_pred").agg(F.count(F.lit(1)).alias("n"))
    key = {"table": "person", "by": ["ancestry_pred"]}
    first = tables.cached_by_parameters(lens.spark, base, key, lambda: build(read()), [read()])
    again = tables.cached_by_parameters(lens.spark, base, dict(reversed(key.items())), lambda: build(read().filter("false")), [read()])
    people.write.mode("append").parquet(f"{base}/people")
    changed = tables.cached_by_parameters(lens.spark, base, key, lambda: build(read()), [read()])
    return first.unionByName(again).unionByName(changed).groupBy("ancestry_pred").agg(F.sum("n").alias("n"))


@query("run_manifest", "SELECT 'people' AS output, COUNT(*) AS n FROM person UNION ALL SELECT 'sites', COUNT(*) FROM annotation")
def manifest(lens: Lens) -> DataFrame:
    """Counts of the written outputs, read from the manifest's JSON."""
    from casewright.plans.drivers import write_outputs

    folder, config = intermediate_path(lens.spark, "run"), {"windows": [365, None]}
    write_outputs(lens.spark, {"people": lens.person.select(*PEOPLE), "sites": lens.annotation.select("variant_id")}, folder, config)
    text = lens.spark.read.text(f"{folder}/manifest.json", wholetext=True)
    read = text.select(F.from_json("value", "config_hash string, counts map<string, bigint>").alias("m"))
    return read.filter(F.col("m.config_hash") == parameter_hash(config)).select(F.explode("m.counts").alias("output", "n"))


@query(
    "fam_sample_import",
    """SELECT person_id, ancestry_pred FROM person WHERE CAST(person_id AS BIGINT) % 3 = 0""",
)
def fam(lens: Lens) -> DataFrame:
    """People listed in a .fam file."""
    path = intermediate_path(lens.spark, "fam")
    lens.person.filter(F.col("person_id").cast("long") % 3 == 0).select(F.concat_ws(" ", F.lit("0"), "person_id", F.lit("0 0 2 -9"))).write.text(path)
    return samples.genotyped_sample(lens.person, genetics.fam_ids(lens.spark, path)).select("person_id", "ancestry_pred")


@query("bim_variant_counts", "SELECT 'total' AS metric, COUNT(*) AS n FROM annotation UNION ALL SELECT 'selected', COUNT(*) FROM annotation WHERE chromosome IN ('1', '22')")
def bim(lens: Lens) -> DataFrame:
    path = intermediate_path(lens.spark, "bim")
    lens.annotation.select(F.concat_ws("\t", F.concat(F.lit("chr"), "chromosome"), "variant_id", F.lit("0"), F.col("position").cast("string"), F.lit("A"), F.lit("C"))).write.text(path)
    return genetics.bim_counts(lens.spark, path, ["1", "22"])


@query(
    "association_import",
    """SELECT variant_id, chromosome, position, 'G' AS effect_allele, ROUND(ln(revel + 0.5), 6) + 0.0 AS beta, ROUND(revel + 0.5, 6) AS odds_ratio, ROUND(max_af * 500, 6) AS regression_p FROM annotation WHERE CAST(substr(variant_id, 2) AS BIGINT) % 5 <> 0""",
)
def association_import(lens: Lens) -> DataFrame:
    """Additive tests with odds ratios, and rows of another test, from a tool's whitespace-separated output."""
    number = F.substring("variant_id", 2, 20).cast("long")
    rows = lens.annotation.select(
        F.concat(F.lit("chr"), "chromosome").alias("#CHROM"), F.col("position").alias("POS"), F.col("variant_id").alias("ID"), F.lit("G").alias("A1"),
        F.when(number % 5 == 0, "DOMDEV").otherwise("ADD").alias("TEST"), (F.col("revel") + 0.5).alias("OR"), (F.col("max_af") * 500).alias("P"),
    )
    path = tables.write_space_delimited(rows, intermediate_path(lens.spark, "assoc"), header=True)
    return genetics.read_association_results(lens.spark, path).select("variant_id", "chromosome", "position", "effect_allele", "beta", "odds_ratio", "regression_p")


@query("clumped_ids_import", "SELECT variant_id FROM annotation WHERE position % 40000 = 0")
def clumped(lens: Lens) -> DataFrame:
    rows = lens.annotation.filter("position % 40000 = 0").select(F.col("chromosome").alias("#CHROM"), F.col("variant_id").alias("ID"))
    return genetics.read_clumped_ids(lens.spark, tables.write_space_delimited(rows, intermediate_path(lens.spark, "clumps"), header=True))


@query("hash_scores", "SELECT person_id, ROUND(CAST('0x' || substr(sha256(person_id), 1, 16) AS UBIGINT)::DOUBLE / 18446744073709551615::DOUBLE, 6) AS hash_score FROM person")
def hash_scores(lens: Lens) -> DataFrame:
    return lens.person.select("person_id", hash_score("person_id").alias("hash_score"))


@query(
    "variant_keys",
    """SELECT variant_id, chromosome || '-' || position || '-A-C' AS variant_key, 'chr' || chromosome || ':' || GREATEST(1, position - 5) || '-' || (position + 5) AS interval FROM annotation""",
)
def variant_keys(lens: Lens) -> DataFrame:
    contig, at = F.concat(F.lit("chr"), "chromosome"), F.col("position")
    return lens.annotation.select("variant_id", variant_key(contig, at, F.lit("A"), F.lit("C")).alias("variant_key"), interval_text(contig, F.greatest(F.lit(1), at - 5), at + 5).alias("interval"))


@query("vector_cells", "SELECT person_id, ROUND(pc1, 6) AS first, ROUND(pc2, 6) AS second, CAST(NULL AS DOUBLE) AS fourth FROM person")
def vectors(lens: Lens) -> DataFrame:
    """Elements of a vector kept as text in one cell; elements that are not there are NULL."""
    cell = F.concat(F.lit("["), F.concat_ws(", ", F.col("pc1").cast("string"), F.col("pc2").cast("string"), F.lit("bad")), F.lit("]"))
    parts = vector_elements(cell, 4)
    return lens.person.select("person_id", parts[0].alias("first"), parts[1].alias("second"), parts[3].alias("fourth"))


@query(
    "allele_counts",
    """SELECT person_id, variant_id, CASE WHEN dosage = 2 THEN 2 WHEN chromosome = '5' THEN NULL ELSE 1 END AS n_alt FROM genotype""",
)
def alleles(lens: Lens) -> DataFrame:
    """Non-reference alleles of called genotypes; a half-called one is missing."""
    gt = F.when(F.col("dosage") == 2, F.array(F.lit(1), F.lit(2))).when(F.col("chromosome") == "5", F.array(F.lit(1), F.lit(None).cast("int"))).otherwise(F.array(F.lit(0), F.lit(3)))
    return lens.genotype.select("person_id", "variant_id", genotypes.n_alt_alleles(gt).alias("n_alt"))


@query(
    "candidate_variants",
    """, raw AS (SELECT variant_id, gene, chromosome, position, clinvar_significance, consequence, revel, max_af FROM annotation WHERE gene IN ('Brand#13', 'Brand#25', 'Brand#42'))
SELECT variant_id, gene, position, ROUND(revel, 6) AS revel, ROUND(max_af, 6) AS max_af FROM raw
WHERE max_af <= 0.001 AND (contains(lower(clinvar_significance), 'red') OR contains(lower(consequence), 'promo') OR revel >= 0.8)""",
)
def candidates(lens: Lens) -> DataFrame:
    """Gene filter, transcript collapse, masks and the primary mask, over an annotation with columns under other names."""
    mapping = {
        "variant_id": "vid", "chromosome": "contig", "position": "position", "ref": "ref_allele", "alt": "alt_allele", "gene": "gene_symbol", "consequence": "consequence", "revel": "revel",
        "max_af": "gnomad_max_af", "gvs": "gvs_max_af", "clinvar_significance": "clinvar_classification",
    }
    twice = lens.annotation.withColumns({"ref": F.lit("A"), "alt": F.lit("C")})
    raw = predicates.project_annotation(twice.unionByName(twice), mapping)
    found = genotypes.candidate_variants(raw, ["Brand#13", "Brand#25", "Brand#42"], CLINVAR_TERMS, PLOF_TERMS)
    return found.select("variant_id", "gene", "position", "revel", "max_af")


@query(
    "extraction_counts",
    SAMPLE_SQL
    + """, tg AS (SELECT variant_id FROM annotation WHERE contains(clinvar_significance, 'red')), cc AS (SELECT * FROM called JOIN tg USING (variant_id) SEMI JOIN sampl USING (person_id) WHERE n_alt > 0)
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT person_id) AS people_with_calls, COUNT(DISTINCT variant_id) AS variants_with_calls, (SELECT COUNT(DISTINCT person_id) FROM sampl) AS people_requested,
  (SELECT COUNT(DISTINCT variant_id) FROM tg) AS variants_requested FROM cc""",
)
def extraction(lens: Lens) -> DataFrame:
    people, targets = sample(lens), lens.annotation.filter(F.col("clinvar_significance").contains("red"))
    calls = called(lens).filter("n_alt > 0").join(people.select("person_id"), "person_id", "left_semi").join(targets.select("variant_id"), "variant_id", "left_semi")
    return genotypes.extraction_stats(calls, people, targets)


@query(
    "score_weights_by_threshold",
    """, w AS (SELECT variant_id, revel - 0.5 AS beta, max_af * 500.0 AS p FROM annotation WHERE max_af * 500.0 <= 0.8), t(label, hi) AS (VALUES ('p0_1', 0.1), ('p0_5', 0.5))
SELECT label AS threshold_label, ROW_NUMBER() OVER (PARTITION BY label ORDER BY p, variant_id) AS place, variant_id, ROUND(p, 6) AS p FROM w JOIN t ON p <= hi""",
)
def weight_ranges(lens: Lens) -> DataFrame:
    """Weights up to a largest p, in order, within each threshold's range."""
    from pyspark.sql import Window

    weights = lens.annotation.select("variant_id", (F.col("revel") - 0.5).alias("beta"), (F.col("max_af") * 500.0).alias("p"))
    kept = scores.sorted_weights(scores.restricted_weights(weights, max_p=0.8))
    ranges = scores.threshold_ranges(lens.spark, [0.1, 0.5]).filter(F.col("threshold_label").isin(threshold_label(0.1), threshold_label(0.5)))
    inside = kept.join(F.broadcast(ranges), F.col("p").between(F.col("lower"), F.col("upper")))  # one row for each threshold
    place = F.row_number().over(Window.partitionBy("threshold_label").orderBy("p", "variant_id"))
    return inside.select("threshold_label", place.alias("place"), "variant_id", "p")


@query(
    "sparse_sample_lists",
    SAMPLE_SQL
    + """, sl AS (SELECT person_id, outcome, pc1, CASE WHEN CAST(person_id AS BIGINT) % 4 = 0 THEN 'test' ELSE 'train' END AS part FROM sampl)
SELECT part AS list, person_id AS IID FROM sl UNION ALL SELECT 'train_controls', person_id FROM sl WHERE part = 'train' AND outcome = 0""",
)
def sample_lists(lens: Lens) -> DataFrame:
    """Train, test and train-control lists over the covariates that both splits have."""
    kept, dropped = samples.shared_covariates(["pc1", "pc9"], ["pc1"])
    split = F.when(F.col("person_id").cast("long") % 4 == 0, "test").otherwise("train")
    rows = sample(lens).withColumnRenamed("outcome", "analysis_case").withColumn("analysis_split", split).select("person_id", "analysis_case", "analysis_split", *kept)
    if dropped != ["pc9"]:
        raise ValueError(f"unexpected covariates: {dropped}")
    lists = samples.split_sample_lists(rows, kept)
    return reduce(DataFrame.unionByName, [frame.select(F.lit(name).alias("list"), "IID") for name, frame in lists.items()])
