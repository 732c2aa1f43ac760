"""Nearest neighbours by largest inner product with an inverted multi-index.

The two halves of a vector are quantised separately, so ``codes`` centroids a half make ``codes``² cells. A query
scores both halves' centroids by inner product (a distance with the sign turned) and walks the cells in falling order
of the sum with a heap, until the cells seen hold ``share`` of all entries and more than ``k``. Those entries are
reranked with the inner product of the original vectors, in double precision.

Centroids are fit on ``FIT_ROWS`` vectors in expectation, taken by a hash of the id; every vector is indexed.
Cells are gathered into units of about ``UNIT`` vectors, and a cell larger than that is spread over several. A vector is
sent once, to its unit; a query is sent to the units that it visits, and streams past the unit's vectors in blocks of
``BLOCK``, so a task holds one unit and one block whatever a cell or the query set holds. Only cell sizes, at most
``codes``² numbers, reach the driver.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component, and rows with a null id,
take no part, and neither do vectors of another than the most frequent length (the greater of equals), which have no inner
product with the others; rows of one id are rows like any other: each is a query of its own, and a candidate of the
other's; ties go to the smaller id; fewer candidates than ``k`` give all that there are; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright.llm.shared import by_rows, cut_lineage

CODES = 16
FIT_ROWS = 8192
#: Share of all entries that a query's cells must hold. Recall is measured in tests/llm.
SHARE = 0.7
UNIT = 2048
BLOCK = 512


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def centroids(sample: np.ndarray, codes: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's k-means, started from rows spread evenly over the sample."""
    distinct = np.unique(sample, axis=0)
    codes = min(codes, len(distinct))
    middle = distinct[np.linspace(0, len(distinct) - 1, codes).astype(int)].astype(float)
    for _ in range(rounds):
        near = nearest(sample, middle)
        sums = np.zeros_like(middle)
        np.add.at(sums, near, sample)
        n = np.bincount(near, minlength=codes)[:, None]
        middle = np.where(n > 0, sums / np.maximum(n, 1), middle)
    return middle


def nearest(x: np.ndarray, middle: np.ndarray) -> np.ndarray:
    return (2 * (x @ middle.T) - (middle * middle).sum(axis=1)).argmax(axis=1)


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
    """Cells by falling summed score until they hold ``enough`` entries; ``first`` and ``second`` score the centroids."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    x, y = first[a], second[b]
    heap, pushed, cells, held = [(-(x[0] + y[0]), 0, 0)], {(0, 0)}, [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(second) + int(b[j])
        if sizes[cell]:
            cells.append(cell)
            held += int(sizes[cell])
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(x) and q < len(y) and (p, q) not in pushed:
                pushed.add((p, q))
                heapq.heappush(heap, (-(x[p] + y[q]), p, q))
    return cells


def _best(ids: np.ndarray, vectors: np.ndarray, query: np.ndarray, scores: np.ndarray, allowed: np.ndarray, k: int, least: float) -> tuple[list, list]:
    """The k nearest allowed that reach ``least``: a blocked product finds them up to rounding, one row-wise sum decides."""
    at = np.flatnonzero(allowed & (scores >= least - 1e-9 * max(1.0, abs(least))))
    if len(at) > k:
        s = scores[at]
        edge = np.partition(s, len(s) - k)[len(s) - k]
        at = at[s >= edge - 1e-9 * max(1.0, abs(edge))]
    exact = (vectors[at] * query).sum(axis=1)
    order = np.lexsort((ids[at], -exact))[:k]
    return ids[at][order].tolist(), exact[order].tolist()


def search(vectors: DataFrame, every: int, k: int, vec_id: str = "vec_id", embedding: str = "embedding", codes: int = CODES, share: float = SHARE, fit_rows: int = FIT_ROWS) -> DataFrame:
    """For each row whose id is divisible by ``every``: ``(query_id, rank, vec_id, score)`` of its ``k`` nearest."""
    good = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    lengths = good.groupBy(F.size("v").alias("size")).count().orderBy(F.col("count").desc(), F.col("size").desc()).head()
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], schema)
    size, total = lengths["size"], lengths["count"]
    good = good.where(F.size("v") == size)
    span = 1 << 20
    sample = good.where(F.pmod(F.xxhash64("id"), F.lit(span)) < min(span, -(-fit_rows * span // total))).select("id", "v").toPandas().sort_values("id")
    if sample.empty:
        sample = good.orderBy("id").limit(1).toPandas()
    fit, half = np.array(sample["v"].tolist()), size // 2
    one = centroids(fit[:, :half], codes) if half else np.zeros((1, 0))
    two = centroids(fit[:, half:], codes)

    def encode(batches):
        for batch in batches:
            x = np.array(batch["v"].tolist()).reshape(len(batch), size)
            cell = nearest(x[:, :half], one) * len(two) + nearest(x[:, half:], two)
            yield pd.DataFrame({"row": batch["row"], "id": batch["id"], "v": batch["v"], "cell": cell.astype("i8")})

    numbered = good.withColumn("row", F.monotonically_increasing_id())  # settled by being written
    index = cut_lineage(numbered.select("row", "id", "v").mapInPandas(encode, "row bigint, id bigint, v array<double>, cell bigint"))
    sizes = np.zeros(len(one) * len(two), dtype=np.int64)
    for r in index.groupBy("cell").count().collect():
        sizes[r["cell"]] = r["count"]
    unit_of, spread = _units(sizes)
    units = int((unit_of + spread).max())
    enough = max(int(np.ceil(share * total)), k + 1)

    def probe():
        def each(row, key, v):
            q = np.array(v)
            cells = walk(one @ q[:half], two @ q[half:], sizes, enough)
            units: dict[int, list[int]] = {}
            for c in cells:
                for u in range(unit_of[c], unit_of[c] + spread[c]):
                    units.setdefault(u, []).append(c)
            return [(row, key, v, u, cs) for u, cs in units.items()]

        return each

    asked = index.where(F.pmod("id", F.lit(every)) == 0).select("row", "id", "v")
    asked = cut_lineage(by_rows(asked, probe, "row bigint, id bigint, v array<double>, unit bigint, cells array<bigint>"))
    begin, width = F.array(*(F.lit(int(u)) for u in unit_of)), F.array(*(F.lit(int(s)) for s in spread))
    cell = F.col("cell").cast("int") + 1
    entries = cut_lineage(index.withColumn("unit", (F.element_at(begin, cell) + F.pmod(F.xxhash64("id", "v"), F.element_at(width, cell))).cast("bigint")))
    nothing = lambda kind: F.lit(None).cast(kind)

    def rerank(frames):
        unit, ids, rows, cells, x, parts = None, None, None, None, None, []
        for frame in frames:
            for now, group in frame.groupby("unit", sort=False):
                if now != unit:
                    unit, parts, x = now, [], None
                stored, queries = group[group["kind"] == 0], group[group["kind"] == 1]
                if len(stored):
                    parts.append(stored)
                if not len(queries) or not parts:
                    continue
                if x is None:  # all of the unit's vectors have come
                    whole = pd.concat(parts)
                    ids, rows, cells, x = whole["id"].to_numpy(), whole["row"].to_numpy(), whole["cell"].to_numpy(), np.array(whole["v"].tolist())
                for at in range(0, len(queries), BLOCK):
                    block, out = queries.iloc[at : at + BLOCK], []
                    q = np.array(block["v"].tolist())
                    scores = q @ x.T
                    for i, (row, key, own, least) in enumerate(zip(block["row"], block["id"], block["cells"], block["least"])):
                        near = _best(ids, x, q[i], scores[i], np.isin(cells, own) & (rows != row), k, least)
                        out.extend((row, key, *pair) for pair in zip(*near))
                    yield pd.DataFrame(out, columns=["row", "query_id", "vec_id", "score"])

    # Units go in rounds, one first and then four times as many as before. Each round begins with the k-th best scores
    # of the ones before, so few entries leave a unit for nothing, however many units there are.
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    near, done, upto = None, 0, 1
    while done < units:
        here = (F.col("unit") >= done) & (F.col("unit") < upto)
        now = asked.where(here)
        if near is None:
            now = now.withColumn("least", F.lit(-float("inf")))
        else:
            least = near.groupBy("row").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(-float("inf")).alias("least"))
            now = now.join(least, "row", "left").na.fill(-float("inf"), ["least"])
        held = entries.where(here).select("unit", F.lit(0).alias("kind"), "row", "id", "v", "cell", nothing("array<bigint>").alias("cells"), nothing("double").alias("least"))
        sent = now.select("unit", F.lit(1).alias("kind"), "row", "id", "v", nothing("bigint").alias("cell"), "cells", "least")
        tasks = min(upto - done, units - done)
        met = held.unionByName(sent).repartitionById(tasks, (F.col("unit") - done).cast("int")).sortWithinPartitions("unit", "kind")
        found = met.mapInPandas(rerank, "row bigint, query_id bigint, vec_id bigint, score double")
        near = found if near is None else near.unionByName(found)
        near = cut_lineage(near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("row", "query_id", "vec_id", "score"))
        done, upto = upto, 4 * upto
    return near.withColumn("rank", F.row_number().over(order)).select("query_id", "rank", "vec_id", "score")


def _units(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First unit and number of units of each cell: small cells share one, a large one has several of its own."""
    unit_of, spread = np.zeros(len(sizes), dtype=int), np.ones(len(sizes), dtype=int)
    unit, held = 0, 0
    for c, n in enumerate(sizes):
        if n > UNIT:
            unit += 1 if held else 0
            unit_of[c], spread[c] = unit, -(-n // UNIT)
            unit, held = unit + spread[c], 0
        else:
            if held + n > UNIT:
                unit, held = unit + 1, 0
            unit_of[c] = unit
            held += n
    return unit_of, spread
