"""Small helpers of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from casewright.session import cut_lineage

__all__ = ["SEEDS", "arrow_fields", "by_rows", "components", "cut_lineage", "mix", "table", "table_of"]

#: Rows that a Python task hands back at once.
OUT_ROWS = 2048

SEEDS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def mix(x: np.ndarray) -> np.ndarray:
    """Hash of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def by_rows(df: DataFrame, make: Callable[[], Callable[..., Iterator[tuple]]], schema: str, finish: bool = False) -> DataFrame:
    """Map rows to any number of rows, in Arrow batches.

    ``make()`` runs once in a task and returns a function from a row's values to an iterable of result tuples.
    With ``finish`` it returns that function and a second one, called without values after the last row.
    """
    fields = arrow_fields(schema)

    def run(batches):
        made = make()
        each, last = made if finish else (made, None)
        out: list[tuple] = []

        def flushed():
            columns = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])

        for batch in batches:
            # slices bound the Python objects alive at once, however long the texts are
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for row in zip(*(c.to_pylist() for c in part.columns)):
                    out.extend(each(*row))
                    if len(out) >= OUT_ROWS:
                        yield flushed()
                        out.clear()
                if out:
                    yield flushed()
                    out.clear()
        for got in last() if last else ():
            out.append(got)
            if len(out) >= OUT_ROWS:
                yield flushed()
                out.clear()
        if out:
            yield flushed()

    return df.mapInArrow(run, schema)


def arrow_fields(schema: str) -> list[tuple[str, pa.DataType]]:
    return [(f.name, to_arrow_type(f.dataType)) for f in StructType.fromDDL(schema).fields]


def table_of(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    """One batch of rows, of which there is one at least."""
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges (a long, b long)``: one row ``(node, comp)`` for each node, the smallest node as comp.

    Every node points at its smallest neighbour, pointers are doubled until all point at roots, the edges are
    contracted to roots, and what is left goes through the same again. Both loops take a number of rounds that is
    logarithmic in the number of nodes, and end when nothing is left to do. Each round is a written table.
    """
    named = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    left = cut_lineage(named)
    labels: DataFrame | None = None
    while not left.isEmpty():
        both = left.select(F.col("b").alias("node"), F.col("a").alias("to")).unionByName(left.select(F.col("a").alias("node"), F.col("b").alias("to")))
        up = cut_lineage(both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("to")))
        while True:
            jump = up.select(F.col("node").alias("to"), F.col("to").alias("top"))
            new = cut_lineage(up.join(jump, "to").select("node", F.col("top").alias("to"), (F.col("top") != F.col("to")).alias("moved")))
            up = new.select("node", "to")
            if new.where("moved").isEmpty():
                break
        if labels is None:
            labels = up.select("node", F.col("to").alias("comp"))
        else:
            labels = labels.join(up.select(F.col("node").alias("comp"), "to"), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
        labels = cut_lineage(labels)
        left = left.join(up.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a").join(up.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
        left = cut_lineage(left.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).where("a < b").distinct())
    if labels is None:
        labels = named.select(F.col("a").alias("node"), F.col("b").alias("comp")).limit(0)
    return labels
