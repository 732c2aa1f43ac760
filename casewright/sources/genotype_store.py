"""Stored genotypes that are read in part: by interval, or joined without an exchange.

``write_ranges`` lays long genotypes out by contig and by bins of positions, sorted inside the files. A bin is a folder, so
bins widen where the positions would make too many of them; the width is kept with the rows. ``read_intervals`` then opens only what intervals need: few of them become literal predicates, which prune partitions, files and row groups
before anything runs; many become a join on the partition columns, by whose keys Spark prunes partitions while it runs.

``write_bucketed`` keeps a table in buckets of one key, sorted by it. Two tables in as many buckets of the same key join,
and one aggregates by it, without an exchange.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casewright.session import BROADCAST_LIMIT_BYTES, cut_lineage

#: Positions of a bin, and how many intervals are written out as literals.
BIN_POSITIONS, FEW_INTERVALS = 10_000_000, 64
BIN, BIN_WIDTH = "position_bin", "bin_width"
#: Bins, that is folders, of a store, at most about.
BIN_LIMIT = 2048
#: A bin's row in a broadcast, at most about.
BIN_ROW_BYTES = 96


def _bin_name(contig: Column, number: Column) -> Column:
    """One partition key for contig and bin: two keys would be pruned apart, by any contig with any bin."""
    return F.concat_ws("_bin", contig.cast("string"), number.cast("bigint").cast("string"))


def write_ranges(genotypes: DataFrame, path: str, contig: str = "chromosome", bin_positions: int = BIN_POSITIONS) -> str:
    """Genotypes by contig and bin of positions. Range partitioning cuts a large bin into many files, sorted by position.

    A bin covers ``bin_positions``, or a multiple of it where the contigs' ranges hold more than ``BIN_LIMIT`` such bins.
    """
    genotypes = cut_lineage(genotypes)  # read for its ranges, for the cuts and for the rows
    number = F.floor(F.col("position") / bin_positions)
    ranges = genotypes.groupBy(contig).agg((F.max(number) - F.min(number) + 1).alias("n"))
    bins = ranges.agg(F.sum("n").alias("n")).first()["n"] or 0
    width = bin_positions * max(1, -(-bins // BIN_LIMIT))
    binned = genotypes.withColumns({BIN_WIDTH: F.lit(width).cast("bigint"), BIN: _bin_name(F.col(contig), F.floor(F.col("position") / width))})
    order = [c for c in (contig, "position", "person_id") if c in binned.columns]
    ranged = binned.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").partitionBy(BIN_WIDTH, contig, BIN).parquet(path)
    return path


def read_intervals(
    spark: SparkSession, path: str, intervals: DataFrame, contig: str = "chromosome", bin_positions: int = BIN_POSITIONS, few: int = FEW_INTERVALS
) -> DataFrame:
    """Rows of the stored genotypes whose position lies in any of ``intervals (contig, start, end)``.

    Intervals that overlap give a row once. No interval gives no row.
    """
    # a contig's name must stay text, whatever the folder names look like
    stored = _read_text_contig(spark, path, contig)
    first = stored.select(BIN_WIDTH).first()
    width = first[BIN_WIDTH] if first else bin_positions
    stored = stored.drop(BIN_WIDTH)
    asked = intervals.select(F.col("contig").cast("string").alias("contig"), F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"))
    asked = asked.filter("start <= end").distinct()
    literal = asked.limit(few + 1).collect()
    if len(literal) <= few:
        return stored.filter(_literal(literal, contig, width)).drop(BIN)
    # a row meets the intervals of its own cell of ``bin_positions`` alone, however wide the bins are
    cell = lambda c: F.floor(F.col(c) / bin_positions)
    cells = asked.select("contig", "start", "end", F.explode(F.sequence(cell("start"), cell("end"))).alias("_cell"))
    number = F.floor(F.col("_cell") * bin_positions / width)
    bins = cut_lineage(cells.select(_bin_name(F.col("contig"), number).alias("_bin"), "_cell", "start", "end"))
    # Spark prunes partitions by the keys of a join's other side where that side is broadcast, and looks for a filter there
    side = bins.filter("end >= start")
    if bins.count() * BIN_ROW_BYTES <= BROADCAST_LIMIT_BYTES:
        side = F.broadcast(side)
    on = (F.col(BIN) == F.col("_bin")) & (cell("position") == F.col("_cell")) & F.col("position").between(F.col("start"), F.col("end"))
    met = stored.join(side, on, "left_semi")
    return met.drop(BIN)


def _read_text_contig(spark: SparkSession, path: str, contig: str) -> DataFrame:
    sample = spark.read.parquet(path)
    if dict(sample.dtypes)[contig] == "string":
        return sample
    schema = ", ".join(f"`{f.name}` {'string' if f.name == contig else f.dataType.simpleString()}" for f in sample.schema)
    return spark.read.schema(schema).parquet(path)


def _literal(intervals: Sequence, contig: str, bin_positions: int) -> Column:
    if not intervals:
        return F.lit(False)

    def within(r) -> Column:
        bins = range(r["start"] // bin_positions, r["end"] // bin_positions + 1)
        at = (F.col(contig) == r["contig"]) & F.col("position").between(r["start"], r["end"])
        return at & F.col(BIN).isin([f"{r['contig']}_bin{b}" for b in bins]) if len(bins) <= FEW_INTERVALS else at

    return reduce(or_, map(within, intervals))


def scanned_files(df: DataFrame) -> int:
    """Number of files that hold the result's rows."""
    return df.select(F.col("_metadata.file_path").alias("file")).distinct().count()


def write_bucketed(df: DataFrame, by: str, buckets: int, path: str, name: str | None = None) -> DataFrame:
    """``df`` in ``buckets`` buckets of ``by``, sorted by it, registered as a table over ``path`` and read back."""
    spark = df.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex}"
    # one task for each bucket, so a bucket is one file and its order holds
    df.repartition(buckets, F.col(by)).write.mode("overwrite").bucketBy(buckets, by).sortBy(by).option("path", path).saveAsTable(name)
    return spark.table(name)


