"""Clinical and genotype views over the provided star-schema tables.

Every registered query reads these views, so its work grows with the tables. ``LENS_SQL`` states the
same views as SQL for the oracle; the two are kept side by side on purpose.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright.rules import Concepts, Controls, DayWindow, Evidence, IncidentRules, Matching, PhenotypeRules, Reading, Tier, Tolerance

COFACTORS = (
    Concepts((11,), label="crush_injury"),
    Concepts((12,), label="sepsis"),
    Concepts((13,), label="renal_injury"),
)
TARGET = Concepts((3, 4, 5))
RULES = PhenotypeRules(
    broad=Tier(Evidence.CONDITION, TARGET),
    definite=Tier(Evidence.BOTH, TARGET, Reading(Concepts((0, 1, 2, 3)), 45.0), DayWindow(-30, 365)),
    cofactors=COFACTORS,
    no_controls=Concepts((99,)),
)
MATCHING = Matching(within=Tolerance(days=730), controls=Controls(wanted=1))
INCIDENT = IncidentRules(
    target=Concepts((3, 4, 5, 6, 7, 8), label="target"),
    lab=Concepts((0, 1, 2, 3), label="ck"),
    lab_min=45.0,
    lab_window=(-90, 365),
    trauma=(Concepts((11,), label="crush_injury"), Concepts((14,), label="major_trauma")),
    sepsis=(Concepts((12,), label="sepsis"),),
    supportive=(Concepts((15,), label="exertion_exercise"), Concepts((), ("-16",), label="heat_illness")),
    history={
        "prior_kidney_disease_or_aki": (Concepts((13, 21, 22, 23), label="kidney_disease"),),
        "remote_sepsis_history": (Concepts((12,), label="sepsis"),),
        "prior_heat_illness_or_dehydration": (Concepts((41,)), Concepts((42,))),
        "prior_exertion_or_exercise_code": (Concepts((43, 44)),),
        "prior_myopathy_muscle_disease": (Concepts((45, 46, 47)),),
        "prior_sickle_trait_or_disease": (Concepts((48,)),),
        "prior_diabetes": (Concepts((31, 32, 33, 34), label="diabetes"),),
        "prior_thyroid_disease": (Concepts((51, 52)),),
        "prior_liver_disease": (Concepts((53, 54, 55)),),
        "prior_alcohol_substance_condition": (Concepts((), ("urgent",)),),
        "prior_injury_trauma_history": (Concepts((61, 62, 63, 64)),),
    },
    labs=(
        Concepts((0, 1, 2, 3), label="ck"),
        Concepts((4, 5), label="creatinine"),
        Concepts((10,), label="ast"),
        Concepts((11,), label="alt"),
        Concepts((6, 7), label="sodium"),
        Concepts((), ("lab 8", "lab 9"), label="potassium"),
        Concepts((12, 13), label="calcium"),
        Concepts((14,), label="tsh"),
    ),
    trauma_window=(-30, 30),
    sepsis_window=(-90, 0),
    supportive_window=(-365, 365),
    horizon_days=730,
)


@dataclass(frozen=True)
class Lens:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def person(self) -> DataFrame:
        c, n, r = self.table("customer"), self.table("nation"), self.table("region")
        key = F.col("c_custkey")
        return (
            c.join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(
                key.cast("string").alias("person_id"),
                (1940 + key % 50).cast("double").alias("year_of_birth"),
                F.when(key % 7 < 3, "female").when(key % 7 < 6, "male").alias("sex"),
                F.col("r_name").alias("ancestry_pred"),
                *[(((key * (7919 + i)) % 1000) / 500.0 - 1.0).alias(f"pc{i}") for i in range(1, 4)],
                F.col("c_acctbal").alias("score"),
                F.when(key % 5 != 0, 1).otherwise(0).alias("has_wgs"),
            )
        )

    @cached_property
    def demographics(self) -> DataFrame:
        return self.person.select("person_id", "year_of_birth", "sex")

    @cached_property
    def ancestry(self) -> DataFrame:
        return self.person.select("person_id", "ancestry_pred", "pc1", "pc2", "pc3")

    @cached_property
    def observation_period(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_custkey").cast("string").alias("person_id"),
            F.col("o_orderdate").cast("date").alias("period_start_date"),
            F.col("o_orderdate").cast("date").alias("period_end_date"),
        )

    @cached_property
    def condition(self) -> DataFrame:
        concept = F.col("o_orderkey") % 100
        return self.table("orders").select(
            F.col("o_custkey").cast("string").alias("person_id"),
            concept.alias("concept_id"),
            F.concat_ws("-", "o_orderpriority", concept.cast("string")).alias("concept_name"),
            F.col("o_orderdate").cast("date").alias("event_date"),
            F.when(F.col("o_orderstatus") != "P", "ICD10CM").otherwise("SNOMED").alias("source_vocabulary"),
        )

    @cached_property
    def measurement(self) -> DataFrame:
        lines, orders = self.table("lineitem"), self.table("orders")
        concept = F.col("l_partkey") % 20
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
            F.col("o_custkey").cast("string").alias("person_id"),
            concept.alias("concept_id"),
            F.concat(F.lit("lab "), concept.cast("string")).alias("concept_name"),
            F.col("l_quantity").alias("value"),
            F.col("l_shipdate").cast("date").alias("event_date"),
        )

    @cached_property
    def genotype(self) -> DataFrame:
        """Sparse non-reference entries: one row per (person, variant) the person's orders contain."""
        lines, orders = self.table("lineitem"), self.table("orders")
        # grouped by numbers, with a numeric maximum, so the aggregate hashes: a text maximum makes it sort all rows
        status = F.when(F.col("l_linestatus") > "O", 2).when(F.col("l_linestatus") == "O", 1).otherwise(0)
        return (
            lines.join(orders, lines.l_orderkey == orders.o_orderkey)
            .groupBy(F.col("o_custkey").alias("_person"), F.col("l_partkey").alias("_part"))
            .agg(F.least(F.lit(2), F.count(F.lit(1))).cast("int").alias("dosage"), F.max(status).alias("_status"))
            .select(
                F.col("_person").cast("string").alias("person_id"),
                F.concat(F.lit("v"), F.col("_part").cast("string")).alias("variant_id"),
                (1 + F.col("_part") % 22).cast("string").alias("chromosome"),
                ((F.col("_part") + 1) * 10000).alias("position"),
                "dosage",
                F.when(F.col("_status") == 1, "PASS").otherwise("FAIL").alias("ft"),
            )
        )

    @cached_property
    def annotation(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            F.concat(F.lit("v"), key.cast("string")).alias("variant_id"),
            (1 + key % 22).cast("string").alias("chromosome"),
            ((key + 1) * 10000).alias("position"),
            F.col("p_brand").alias("gene"),
            F.col("p_type").alias("consequence"),
            ((key % 100) / 100.0).alias("revel"),
            (F.col("p_size") / 25000.0).alias("max_af"),
            F.col("p_name").alias("clinvar_significance"),
            F.array(
                F.substring(F.lit("ACGT"), (key % 4 + 1).cast("int"), F.lit(1)),
                F.when(key % 10 == 7, "AT").otherwise(
                    F.substring(F.lit("ACGT"), ((key + 1) % 4 + 1).cast("int"), F.lit(1))
                ),
            ).alias("alleles"),
        )


# The annotation terms that stand for P/LP and pLoF in the lens.
CLINVAR_TERMS = ("red",)
PLOF_TERMS = ("promo",)

LENS_SQL = """
person AS (
  SELECT CAST(c_custkey AS VARCHAR) AS person_id, CAST(1940 + c_custkey % 50 AS DOUBLE) AS year_of_birth,
    CASE WHEN c_custkey % 7 < 3 THEN 'female' WHEN c_custkey % 7 < 6 THEN 'male' END AS sex,
    CASE WHEN c_custkey % 7 < 3 THEN 1.0::DOUBLE WHEN c_custkey % 7 < 6 THEN 0.0::DOUBLE END AS is_female,
    r_name AS ancestry_pred,
    CAST((c_custkey * 7920) % 1000 AS DOUBLE) / 500.0::DOUBLE - 1.0::DOUBLE AS pc1,
    CAST((c_custkey * 7921) % 1000 AS DOUBLE) / 500.0::DOUBLE - 1.0::DOUBLE AS pc2,
    CAST((c_custkey * 7922) % 1000 AS DOUBLE) / 500.0::DOUBLE - 1.0::DOUBLE AS pc3,
    c_acctbal AS score, CASE WHEN c_custkey % 5 <> 0 THEN 1 ELSE 0 END AS has_wgs
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
condition AS (
  SELECT CAST(o_custkey AS VARCHAR) AS person_id, o_orderkey % 100 AS concept_id,
    o_orderpriority || '-' || CAST(o_orderkey % 100 AS VARCHAR) AS concept_name,
    CAST(o_orderdate AS DATE) AS event_date,
    CASE WHEN o_orderstatus <> 'P' THEN 'ICD10CM' ELSE 'SNOMED' END AS source_vocabulary
  FROM orders
),
measurement AS (
  SELECT CAST(o_custkey AS VARCHAR) AS person_id, l_partkey % 20 AS concept_id,
    'lab ' || CAST(l_partkey % 20 AS VARCHAR) AS concept_name,
    l_quantity AS value, CAST(l_shipdate AS DATE) AS event_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
obs AS (
  SELECT person_id, MIN(event_date) AS obs_start_date, MAX(event_date) AS obs_end_date FROM condition GROUP BY 1
),
genotype AS (
  SELECT CAST(o_custkey AS VARCHAR) AS person_id, 'v' || CAST(l_partkey AS VARCHAR) AS variant_id,
    CAST(1 + l_partkey % 22 AS VARCHAR) AS chromosome, (l_partkey + 1) * 10000 AS position,
    LEAST(2, COUNT(*)) AS dosage, CASE WHEN MAX(l_linestatus) = 'O' THEN 'PASS' ELSE 'FAIL' END AS ft
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey
),
annotation AS (
  SELECT 'v' || CAST(p_partkey AS VARCHAR) AS variant_id, CAST(1 + p_partkey % 22 AS VARCHAR) AS chromosome,
    (p_partkey + 1) * 10000 AS position, p_brand AS gene, p_type AS consequence,
    CAST(p_partkey % 100 AS DOUBLE) / 100.0::DOUBLE AS revel, CAST(p_size AS DOUBLE) / 25000.0::DOUBLE AS max_af,
    p_name AS clinvar_significance, p_partkey % 10 <> 7 AS biallelic
  FROM part
)
"""
