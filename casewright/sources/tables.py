"""Reading and writing tables by file extension, and small metadata sinks."""

from __future__ import annotations

import gzip
import json
import re
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from casewright.functions.scalars import parameter_hash

TAB_SUFFIXES = (".tsv", ".tsv.gz", ".txt")
COMMA_SUFFIXES = (".csv", ".csv.gz")
BGZ_SUFFIXES = (".bgz",)
BATCH_LINES = 50_000
# The writer quotes cells that begin with its comment sign, "#" unless another one is set: tools want #CHROM bare.
NO_COMMENT = "\u0001"


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Sorted paths matching a pattern; the file contents are not read."""
    return sorted(r.path for r in spark.read.format("binaryFile").load(pattern).select("path").collect())


def resolve_path(spark: SparkSession, path: str) -> str:
    """A wildcard path becomes its first match in sorted order."""
    if "*" not in path and "?" not in path:
        return path
    matches = list_paths(spark, path)
    if not matches:
        raise FileNotFoundError(path)
    return matches[0]


def _open(path: str):
    """Random access to a file by its URI, whatever the file system."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if re.match(r"file:/[^/]", path) else path)
    return system.open_input_file(inner)


# Fixed values of the block-gzip format: how every block begins, and the largest block.
BGZ_MAGIC = b"\x1f\x8b\x08\x04"
BGZ_BLOCK = 1 << 16
SPLIT_BYTES = 64 * 1024 * 1024


def _block_size(head: bytes) -> int:
    """Bytes of the block that begins with ``head``; 0 if none begins there."""
    if len(head) < 18 or head[:4] != BGZ_MAGIC or head[12:16] != b"BC\x02\x00":
        return 0
    return int.from_bytes(head[16:18], "little") + 1


def _first_block(file, start: int, size: int) -> int:
    """Offset of the first block at or after ``start``: its successor, or the end of the file, must follow it."""
    file.seek(start)
    window = file.read(2 * BGZ_BLOCK)
    at = window.find(BGZ_MAGIC)
    while at >= 0:
        n = _block_size(window[at : at + 18])
        follows = start + at + n
        if n and (follows == size or _block_size(_bytes_at(file, follows, 18))):
            return start + at
        at = window.find(BGZ_MAGIC, at + 1)
    return size


def _bytes_at(file, at: int, n: int) -> bytes:
    file.seek(at)
    return file.read(n)


def _lines_of_range(path: str, start: int, end: int) -> Iterator[str]:
    """Lines of the blocks that begin in [start, end). A range after the first leaves its first line, whole or not, to
    the range before, which reads on to the end of one more line. A gzip file without blocks is read by its first range."""
    with _open(path) as file:
        size = file.size()
        if not _block_size(_bytes_at(file, 0, 18)):
            if start == 0:
                file.seek(0)
                with gzip.open(file, "rt") as text:
                    yield from (line.rstrip("\r\n") for line in text)
            return
        at = _first_block(file, start, size)
        if at >= end:
            return
        rest, skip = b"", start > 0
        while at < size:
            n = _block_size(_bytes_at(file, at, 18))
            if not n:
                raise ValueError(f"broken block at {at} of {path}")
            rest += zlib.decompress(_bytes_at(file, at, n), wbits=31)
            beyond = at >= end
            *whole, rest = rest.split(b"\n")
            if skip and whole:
                whole, skip = whole[1:], False
            if beyond:
                if whole:
                    yield whole[0].decode().rstrip("\r")
                    return
            else:
                yield from (line.decode().rstrip("\r") for line in whole)
            at += n
        if rest and not skip:
            yield rest.decode().rstrip("\r")


def read_bgzip_lines(spark: SparkSession, pattern: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines of block-gzipped files, whose suffix Hadoop codecs do not know. A large file is read in ranges of blocks."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "length")
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("long")))
    ranges = files.select("path", begin.alias("start")).withColumn("end", F.col("start") + split_bytes)
    ranges = ranges.repartition(max(ranges.count(), 1), "path", "start")

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, start, end in zip(pdf["path"], pdf["start"], pdf["end"]):
                block: list[str] = []
                for line in _lines_of_range(path, int(start), int(end)):
                    block.append(line)
                    if len(block) == BATCH_LINES:
                        yield pd.DataFrame({"value": block})
                        block = []
                yield pd.DataFrame({"value": block}, dtype="object")

    return ranges.mapInPandas(lines, "value string")


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read by extension; a name without a known extension is a catalog table.

    Text tables have a header. Without ``schema`` every column is text, and operators coerce it.
    """
    if path.startswith("bq://"):
        return spark.table(path.removeprefix("bq://"))
    if path.endswith(".parquet"):
        return spark.read.parquet(resolve_path(spark, path))
    if path.endswith(BGZ_SUFFIXES):
        return from_delimited_lines(read_bgzip_lines(spark, path), "\t")
    for suffixes, sep in ((TAB_SUFFIXES, "\t"), (COMMA_SUFFIXES, ",")):
        if path.endswith(suffixes):
            reader = spark.read.option("header", True).option("sep", sep)
            return (reader.schema(schema) if schema else reader).csv(resolve_path(spark, path))
    if "/" not in path:
        return spark.table(path)
    raise ValueError(f"unsupported table format: {path}")


def from_delimited_lines(lines: DataFrame, sep: str | None) -> DataFrame:
    """Split header-led text lines into text columns; ``sep=None`` splits on runs of whitespace."""
    lines = lines.filter(F.trim("value") != "")
    header = lines.first()
    if header is None:
        return lines.limit(0)
    names = header["value"].split(sep)
    pattern = r"\s+" if sep is None else sep
    text = F.trim("value") if sep is None else F.col("value")
    cells = F.split(text, pattern)
    return lines.filter(F.col("value") != header["value"]).select(
        *[F.nullif(F.get(cells, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]
    )


def read_whitespace(spark: SparkSession, path: str) -> DataFrame:
    return from_delimited_lines(spark.read.text(path), None)


# The order in which ordered outputs list their rows.
COHORT_ORDER = ("case_tier", "index_date", "person_id")
# of every unit's association rows; the unit itself comes last
ASSOCIATION_ORDER = ("comparison", "fisher_p", "regression_p")


def write_table(df: DataFrame, path: str, mode: str = "overwrite", order: Sequence[str] = ()) -> str:
    """Parquet, tab or comma folder by extension; NULL is an empty cell. Every task writes its own part.

    With ``order`` the parts follow each other in that order, missing values last.
    """
    if order:
        df = df.orderBy(*[F.col(c).asc_nulls_last() for c in order])
    if path.endswith(".parquet"):
        df.write.mode(mode).parquet(path)
    elif path.endswith((*TAB_SUFFIXES, *COMMA_SUFFIXES)):
        sep = "," if ".csv" in path else "\t"
        writer = df.write.mode(mode).option("header", True).option("comment", NO_COMMENT).option("sep", sep).option("nullValue", "").option("emptyValue", "")
        (writer.option("compression", "gzip") if path.endswith(".gz") else writer).csv(path)
    else:
        raise ValueError(f"unsupported table format: {path}")
    return path


def write_space_delimited(df: DataFrame, path: str, header: bool = False) -> str:
    df.write.mode("overwrite").option("header", header).option("sep", " ").option("comment", NO_COMMENT).csv(path)
    return path


def write_with_separate_header(df: DataFrame, path: str) -> str:
    """Sharded tab files without headers in ``path/parts`` and one header file in ``path/header``."""
    df.write.mode("overwrite").option("header", False).option("sep", "\t").option("nullValue", "").csv(f"{path}/parts")
    header = df.sparkSession.createDataFrame([("\t".join(df.columns),)], "value string")
    header.coalesce(1).write.mode("overwrite").text(f"{path}/header")
    return path


def write_genotypes(df: DataFrame, path: str, partition: str = "chromosome") -> DataFrame:
    """Persist long genotypes by chromosome, sorted by position so row groups prune, and read them back.

    Range partitioning on (chromosome, position, person) cuts a large chromosome into many files.
    """
    order = [c for c in (partition, "position", "person_id") if c in df.columns]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").partitionBy(partition).parquet(path)
    return df.sparkSession.read.parquet(path)


def fingerprint(df: DataFrame) -> str:
    """Names, sizes and times of the files that a frame reads, or its plan where it reads none.

    Files are listed by Spark; only their counts and sums of hashes reach the driver.
    """
    files = df.inputFiles()
    if not files:
        return f"plan {df.semanticHash()}"
    folders = sorted({f.rsplit("/", 1)[0] for f in files})
    listed = df.sparkSession.read.format("binaryFile").load(folders).select("path", "length", F.col("modificationTime").cast("timestamp").alias("time"))
    mark = F.xxhash64("path", "length", F.unix_micros("time")).cast("decimal(38,0)")
    row = listed.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"), F.sum(mark).alias("sum"), F.bit_xor(F.xxhash64("path", "length", F.unix_micros("time"))).alias("xor")).first()
    return f"files {row['n']} {row['bytes']} {row['sum']} {row['xor']}"


def cached_by_parameters(spark: SparkSession, folder: str, parameters: object, build, inputs: Sequence[DataFrame] = ()) -> DataFrame:
    """Result cache keyed by the hash of its parameters and of its inputs: built and written once, read afterwards.

    A changed input file, or another one, makes another key.
    """
    key = [parameters, *(fingerprint(df) for df in inputs)] if inputs else parameters
    path = f"{folder}/cache-{parameter_hash(key)}.parquet"
    try:
        return spark.read.parquet(path)
    except Exception as error:  # Spark reports a missing path as an analysis error
        if "PATH_NOT_FOUND" not in str(error):
            raise
    build().write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def write_json(spark: SparkSession, payload: dict, path: str) -> str:
    """One small JSON document, written through Spark so any file system works."""
    frame = spark.createDataFrame([(json.dumps(payload, sort_keys=True, default=str),)], "value string")
    frame.coalesce(1).write.mode("overwrite").text(path)
    return path


def write_manifest(spark: SparkSession, config: dict, outputs: dict[str, str], counts: dict, path: str) -> str:
    return write_json(
        spark, {"config": config, "config_hash": parameter_hash(config), "outputs": outputs, "counts": counts}, path
    )
