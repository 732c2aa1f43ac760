"""Distance-based lead hits and the shared round loop for greedy selection in (p, id) order.

Greedy order: a candidate is kept unless an earlier kept one conflicts with it. A round keeps every
candidate that precedes all its open conflicting neighbours, drops their neighbours, and repeats; the
result equals the sequential greedy.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from casewright.session import cut_lineage

# Positions that a task may hold when chunks are widened.
CHUNK_ROWS = 200_000


def lead_hits(results: DataFrame, window_bp: int = 250_000, p: str = "regression_p") -> DataFrame:
    """Variants by ascending p (id breaks ties) with no kept variant within ``window_bp`` on the chromosome.

    NULL p is dropped first. Only the best variant of a position can lead, so a position is reduced before
    anything is shuffled; a chromosome is cut into chunks with a halo of one window on each side, so a
    chunk holds at most its width in positions whatever the share of rows on that chromosome. Rounds go on until
    nothing is open. While the widened chunks stay small they grow fourfold from round to round, so a chain of
    falling p along a chromosome takes a logarithmic number of rounds.
    """
    results = cut_lineage(results.filter(F.col(p).isNotNull()))  # read again for the leads' rows
    best = (
        results
        .groupBy("chromosome", "position")
        .agg(F.min(F.struct(F.col(p).alias("p"), F.col("variant_id").alias("id"))).alias("_b"))
        .select("chromosome", F.col("position").cast("long").alias("position"), F.col("_b.p").alias("p"), F.col("_b.id").alias("id"), F.lit(0).alias("state"))
    )
    width = max(4 * window_bp, 1)
    state = cut_lineage(best)
    schema = "chromosome string, position long, p double, id string, state int"

    def settled(width: int):
        return lambda pdf: settle(pdf, width)

    def settle(pdf: pd.DataFrame, width: int) -> pd.DataFrame:
        """state 0 open, 1 kept, 2 dropped. Only the chunk's own rows see their whole window and may be kept."""
        chunk = int(pdf["_chunk"].iloc[0])
        pdf = pdf.sort_values(["position"], kind="stable", ignore_index=True)
        pos = pdf["position"].to_numpy("int64")
        state = pdf["state"].to_numpy("int64").copy()
        low, high = chunk * width, (chunk + 1) * width
        left = np.searchsorted(pos, pos - window_bp, "left")
        right = np.searchsorted(pos, pos + window_bp, "right")
        own = (pos >= low) & (pos < high)
        order = np.lexsort((pdf["id"].to_numpy(str), pdf["p"].to_numpy(float)))
        done = np.zeros(len(pdf), dtype=bool)
        for i in order:
            near = slice(left[i], right[i])
            if state[i] == 0:
                if (state[near] == 1).any():
                    state[i] = 2
                elif own[i] and not ((state[near] == 0) & done[near]).any():
                    state[i] = 1
            done[i] = True
        pdf["state"] = state
        return pdf.loc[own, ["chromosome", "position", "p", "id", "state"]]

    while True:
        # dropped rows no longer matter; kept rows stay to drop their neighbours
        live = state.filter("state < 2")
        first = F.floor((F.col("position") - window_bp) / width)
        last = F.floor((F.col("position") + window_bp) / width)
        spread = live.withColumn("_chunk", F.explode(F.sequence(first, last)))
        state = cut_lineage(spread.groupBy("chromosome", "_chunk").applyInPandas(settled(width), schema))
        if state.filter("state = 0").isEmpty():
            break
        wider = state.filter("state < 2").groupBy("chromosome", F.floor(F.col("position") / (4 * width))).count()
        if wider.agg(F.max("count")).first()[0] <= CHUNK_ROWS:
            width *= 4
    kept = state.filter("state = 1").select(F.col("id").alias("variant_id"))
    return results.join(kept, "variant_id", "left_semi")
