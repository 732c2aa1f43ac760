"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casewright.session import cut_lineage

# A key with more fact rows than this is dealt over several tasks, about so many rows to each.
HEAVY_ROWS = 1_000_000


def salted_lookup(fact: DataFrame, lookup: DataFrame, key: str, salt_by: str, how: str = "inner", stored: bool = False) -> DataFrame:
    """``fact ⋈ lookup`` on ``key``, a heavy key's fact rows dealt over as many tasks as its counted rows need.

    ``lookup`` has one row (or a few) per key. Keys are counted by a partial aggregate; only the heavy ones, at most
    one for each ``HEAVY_ROWS`` rows, are split, and only their lookup rows are repeated. ``fact`` is written first, unless
    it is a ``stored`` table, because the count and the join both read it.
    """
    fact = fact if stored else cut_lineage(fact)
    heavy = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HEAVY_ROWS)
    heavy = cut_lineage(heavy.select(key, F.ceil(F.col("_n") / HEAVY_ROWS).alias("_parts")))
    if heavy.isEmpty():
        return fact.join(lookup, key, how)
    one = F.lit(1).cast("long")
    left = fact.join(heavy, key, "left").withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.coalesce("_parts", one))).drop("_parts")
    right = lookup.join(heavy, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", one) - 1)))
    return left.join(right.drop("_parts"), [key, "_salt"], how).drop("_salt")
