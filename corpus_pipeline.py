"""From raw documents to packed training sequences: language ID, near-dedup, substring dedup, secret scan, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, written as Parquet and reread as the next one's
``docs``. All but the last return the columns of documents.

Defined results: a text that is null or has no letter is rejected by the first stage, as is one where no language
holds about a third of the letters; ``n_chars`` follows a changed text; an empty table passes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casewright.llm import langid, neardup, queries, secrets, substring
from casewright.llm.shared import cut_lineage

#: Least share of letters that the predicted language must hold.
LEAST_SCORE = 0.35


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language."""
    return langid.keep(docs, langid.train(docs), LEAST_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.kept(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the windows of words that start anywhere else; one that loses nothing keeps its text as it is."""
    cleaned = substring.clean(docs)
    return _with_text(cleaned, F.when(F.col("removed") > 0, F.col("kept")).otherwise(F.col("row.text")), docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found, _ = secrets.findings(docs)
    return _with_text(found, secrets.redacted(F.col("row.text"), F.col("found")), docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.pieces(docs)


def _with_text(rows: DataFrame, text: Column, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from the struct ``row``, with another text and its length."""
    changed = rows.select("row", text.alias("text"))
    new = {"text": F.col("text"), "n_chars": F.length("text")}
    return changed.select(*((new[f.name].cast(f.dataType) if f.name in new else F.col("row")[f.name]).alias(f.name) for f in docs.schema))


STAGES = [
    ("language_id", keep_languages),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("secret_scan", redact_secrets),
    ("packing", pack_documents),
]

#: SQL has no tokenizer and no classifier; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
