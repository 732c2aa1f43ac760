"""Token ids in length-delimited binary record files, with an offset index for shuffled reads.

A record is framed as in the public TFRecord format: the payload's length in eight bytes, a masked CRC-32C of those, the
payload, a masked CRC-32C of the payload. A payload is the document's id, two flags, and its token ids, in two bytes each
where the vocabulary allows it. Rows are range-partitioned by document id, so the files in the order of their names hold
the documents in ascending order, and no task holds more than its file.

Files are written by Spark's own sink and committer (a lost executor's attempt leaves nothing), in blocks of about
``BLOCK_BYTES``. That sink ends every block with one byte. Blocks are therefore cut just before the last byte of a
record's length, which is zero for any length below 2**56, and the sink's byte is that zero: the files hold nothing but
records. The last block ends with a footer record whose checksum ends in a zero byte.

The index is a Parquet table with one row a record: file, offset, length, document id, number of ids. ``shuffled`` reads
records in a random order by it.

Defined results: a null text is an empty one, which still has the closing id; a null document id is kept, before all
others; equal ids stand in the order of their texts' hashes; an empty table gives files without a record; columns other
than the id and the text are not read. A checksum that does not hold stops the read.
"""

from __future__ import annotations

import re
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from casewright.llm.bpe import PLAIN, byte_letters
from casewright.llm.shared import arrow_fields, table_of
from casewright.session import intermediate_path, parallelism

#: Bytes of text for each file, about; a file is read whole by one task.
FILE_BYTES = 16 << 20
BLOCK_BYTES = 1 << 20
CLOSING_ID = 1
#: Words whose ids a task remembers, and the longest of them; past that count it starts anew.
REMEMBERED, LONGEST = 400_000, 64
#: Files whose offsets one window adds up.
FILES_TOGETHER = 4096

# Fixed values of the record format: the reflected CRC-32C polynomial and the mask's rotation and addend.
POLYNOMIAL = 0x82F63B78
MASK_ROTATION, MASK_ADDEND = 15, 0xA282EAD8

_LENGTH, _CRC = "<Q", "<I"
#: document id, 1 if it is null, bytes of an id, zero
_HEAD, _HEAD_BYTES = "<qBBH", 12
_FOOTER_KIND = 2
_CHUNK = 256
INDEX = "file string, number bigint, offset bigint, length bigint, doc_id bigint, n_tokens bigint, start_in_file bigint"
DECODED = "file string, offset bigint, doc_id bigint, start_in_file bigint, n_tokens bigint, ids_crc32 bigint"


# Letters of plain texts in lower case, given one by one: twice as fast as the character categories.
_LETTERS = "".join(sorted({c.lower() for c in map(chr, range(0x250)) if c.isalpha() and len(c.lower()) == 1}))
_WORDS = re.compile(rf"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\s0-9{_LETTERS}]+")


# Checksums ----------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, ...]:
    """Tables by 16 bits that advance a checksum's state over 4 bytes, and over a whole chunk."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(POLYNOMIAL), one >> 1).astype(np.uint32)
    low = np.arange(65536, dtype=np.uint32)
    high = low << np.uint32(16)
    for _ in range(4):
        low, high = (one[s & 0xFF] ^ (s >> np.uint32(8)) for s in (low, high))
    far_low, far_high = low, high
    for _ in range(_CHUNK // 4 - 1):
        far_low, far_high = (low[s & 0xFFFF] ^ high[s >> np.uint32(16)] for s in (far_low, far_high))
    return low, high, far_low, far_high


def masked_checksums(parts: list[bytes]) -> list[int]:
    """Masked CRC-32C of each part, of four bytes or more, all of them at once.

    A state is linear in the bytes, and leading zeros leave the state zero as it is: the initial state goes into the
    first four bytes, parts are filled up with zeros in front, and chunks of all parts advance together.
    """
    if not parts:
        return []
    low, high, far_low, far_high = _tables()
    chunks = [-(-len(p) // _CHUNK) for p in parts]
    ends = np.cumsum(chunks)
    padded = np.zeros(int(ends[-1]) * _CHUNK, dtype=np.uint8)
    for part, end in zip(parts, ends.tolist()):
        to = end * _CHUNK
        padded[to - len(part) : to] = np.frombuffer(part, dtype=np.uint8)
        padded[to - len(part) : to - len(part) + 4] ^= 0xFF
    words = np.ascontiguousarray(padded.view("<u4").reshape(-1, _CHUNK // 4).T)
    states = np.zeros(words.shape[1], dtype=np.uint32)
    for word in words:
        states ^= word
        states = low[states & 0xFFFF] ^ high[states >> np.uint32(16)]
    out, at = [], 0
    states = states.tolist()
    for n in chunks:
        crc = states[at]
        for k in range(at + 1, at + n):
            crc = int(far_low[crc & 0xFFFF]) ^ int(far_high[crc >> 16]) ^ states[k]
        at += n
        crc ^= 0xFFFFFFFF
        out.append(((crc >> MASK_ROTATION | crc << (32 - MASK_ROTATION)) + MASK_ADDEND) & 0xFFFFFFFF)
    return out


def frames(payloads: list[bytes]) -> list[bytes]:
    lengths = [struct.pack(_LENGTH, len(p)) for p in payloads]
    return [
        n + struct.pack(_CRC, a) + p + struct.pack(_CRC, b)
        for n, p, a, b in zip(lengths, payloads, masked_checksums(lengths), masked_checksums(payloads))
    ]


@lru_cache(maxsize=1)
def _footer() -> bytes:
    """A record of no document whose last byte is the zero that the sink adds."""
    payloads = [struct.pack(_HEAD, 0, _FOOTER_KIND, 0, k) for k in range(65536)]
    return next(f for f in frames(payloads) if f[-1] == 0)


# Encoding -----------------------------------------------------------------------------------------


class Ids:
    """A text's ids as little-endian bytes, by the library.

    A plain text is split into the pre-tokenizer's words here, and the library's model merges each new word once. Any
    other text, where the engines' Unicode tables could differ, goes through the library whole.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        size = max(self.library.get_vocab(with_added_tokens=True).values()) + 1
        self.kind, self.width = ("H", 2) if size <= 1 << 16 else ("I", 4)  # native arrays; little-endian machines only
        if sys.byteorder != "little":
            raise RuntimeError("record files are written on little-endian machines only")
        self.model, self.letter = self.library.model, byte_letters()
        self.special = bool(self.library.get_added_tokens_decoder())
        self.words: dict[str, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        return array(self.kind, ids).tobytes()

    def _ids(self, text: str) -> bytes:
        return self._bytes(self.library.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        letters = word if word.isascii() else "".join([self.letter[b] for b in word.encode()])
        got = self._bytes([t.id for t in self.model.tokenize(letters)])
        if len(word) <= LONGEST:
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            self.words[word] = got
        return got

    def __call__(self, text: str) -> bytes:
        if PLAIN.search(text) or (self.special and "<|" in text):
            return self._ids(text)
        known, new = self.words, self._word
        return b"".join([known.get(w) or new(w) for w in _WORDS.findall(text.lower())])

    def payload(self, doc_id: int | None, text: str) -> bytes:
        return struct.pack(_HEAD, doc_id or 0, doc_id is None, self.width, 0) + self(text) + CLOSING_ID.to_bytes(self.width, "little")


@lru_cache(maxsize=2)
def loaded(path: str) -> Ids:
    """One for each Python worker, which runs many tasks."""
    return Ids(path)


def blocks(rows: Iterator[tuple[int | None, str]], payload) -> Iterator[bytes]:
    """Blocks that, each followed by a zero byte, are the records of ``rows`` and the footer."""
    rest, waiting, size = b"", [], 0

    def block() -> tuple[bytes, bytes]:
        framed = frames(waiting)
        return b"".join([rest, *framed[:-1], framed[-1][:7]]), framed[-1][8:]

    for doc_id, text in rows:
        waiting.append(payload(doc_id, text))
        size += len(waiting[-1])
        if size >= BLOCK_BYTES:
            out, rest = block()
            yield out
            waiting, size = [], 0
    if waiting:
        out, rest = block()
        yield out
    if rest:
        yield rest + _footer()[:-1]


def write(docs: DataFrame, tokenizer: str, folder: str, doc_id: str = "doc_id", text: str = "text", file_bytes: int = FILE_BYTES) -> None:
    """Record files of all rows under ``folder``/records, and their index under ``folder``/index."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("a"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("b"))
    total = rows.agg(F.sum(F.octet_length("b").cast("bigint") + 16)).first()[0] or 0
    # the hash and the row number deal one id's rows over several files, however many there are
    keyed = rows.select("a", F.xxhash64("b").alias("h"), F.monotonically_increasing_id().alias("r"), "b")
    order = [F.col("a").asc_nulls_first(), F.col("h").asc(), F.col("r").asc()]
    files = max(parallelism(spark), -(-total // file_bytes))
    sorted_rows = keyed.repartitionByRange(files, *order).sortWithinPartitions(*order).select("a", "b")

    def run(batches):
        ids = loaded(tokenizer)
        each = (row for batch in batches for at in range(0, batch.num_rows, 256) for row in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)))
        for block in blocks(each, ids.payload):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], names=["value"])

    framed = sorted_rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    framed.write.option("lineSep", "\0").text(f"{folder}/records")
    _headers(spark, folder).write.parquet(f"{folder}/index")


# Reading ------------------------------------------------------------------------------------------


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """One row a file: its name, which has its number first, and its bytes."""
    return spark.read.format("binaryFile").load(f"{folder}/records").where("length > 0").select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def _walk(content: memoryview) -> Iterator[tuple[int, int]]:
    """(offset, payload length) of each record."""
    at = 0
    while at < len(content):
        n = struct.unpack_from(_LENGTH, content, at)[0]
        yield at, n
        at += n + 16
    if at != len(content):
        raise ValueError("a record file ends within a record")


def _proven(parts: list[bytes], told: list[int]) -> None:
    if masked_checksums(parts) != told:
        raise ValueError("a checksum of a record file does not hold")


def _headers(spark: SparkSession, folder: str) -> DataFrame:
    fields = arrow_fields(INDEX)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                name, content = batch.column(0)[i].as_py(), memoryview(batch.column(1)[i].as_buffer())
                places = list(_walk(content))
                _proven([bytes(content[at : at + 8]) for at, _ in places], [struct.unpack_from(_CRC, content, at + 8)[0] for at, _ in places])
                rows, start = [], 0
                for at, n in places:
                    key, kind, width, _ = struct.unpack_from(_HEAD, content, at + 12)
                    if kind != _FOOTER_KIND:
                        tokens = (n - _HEAD_BYTES) // width
                        rows.append((name, len(rows), at, n, None if kind else key, tokens, start))
                        start += tokens
                if rows:
                    yield table_of(rows, fields)

    return _files(spark, folder).mapInArrow(run, INDEX)


def index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def _record(content: memoryview, at: int, n: int) -> tuple[int | None, np.ndarray]:
    key, kind, width, _ = struct.unpack_from(_HEAD, content, at + 12)
    return None if kind else key, np.frombuffer(content, dtype=f"<u{width}", count=(n - _HEAD_BYTES) // width, offset=at + 12 + _HEAD_BYTES).astype("<u4")


def decoded(spark: SparkSession, folder: str) -> DataFrame:
    """``DECODED`` for every record, both checksums held against the bytes."""
    fields = arrow_fields(DECODED)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                name, content = batch.column(0)[i].as_py(), memoryview(batch.column(1)[i].as_buffer())
                rows, start, parts, told = [], 0, [], []
                for at, n in _walk(content):
                    parts += [bytes(content[at : at + 8]), bytes(content[at + 12 : at + 12 + n])]
                    told += [struct.unpack_from(_CRC, content, at + 8)[0], struct.unpack_from(_CRC, content, at + 12 + n)[0]]
                    if content[at + 20] != _FOOTER_KIND:
                        key, ids = _record(content, at, n)
                        rows.append((name, at, key, start, len(ids), zlib.crc32(ids)))
                        start += len(ids)
                _proven(parts, told)
                if rows:
                    yield table_of(rows, fields)

    return _files(spark, folder).mapInArrow(run, DECODED)


def file_starts(spark: SparkSession, folder: str) -> DataFrame:
    """Ids before each file. Files are added up in groups of ``FILES_TOGETHER``, and then the groups."""
    totals = index(spark, folder).groupBy("file").agg(F.sum("n_tokens").alias("n"))
    number = F.regexp_extract("file", r"^part-(\d+)", 1).cast("bigint")
    grouped = totals.withColumn("part", F.floor(number / FILES_TOGETHER))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = grouped.select("file", "part", before(Window.partitionBy("part").orderBy("file")).alias("within"))
    # one row for each FILES_TOGETHER files
    parts = grouped.groupBy("part").agg(F.sum("n").alias("n")).select("part", before(Window.orderBy("part")).alias("ahead"))
    return within.join(parts, "part").select("file", (F.col("within") + F.col("ahead")).alias("file_start"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row a document: ``doc_id, start, n_tokens, ids_crc32``, from the files."""
    rows = decoded(spark, folder).join(file_starts(spark, folder), "file")
    return rows.select("doc_id", (F.col("file_start") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32")


def shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """``position, doc_id, ids`` of every record in a random order of ``position``, found by the index's offsets."""
    wanted = index(spark, folder).select("file", "offset", "length", F.xxhash64(F.lit(seed), "file", "offset").alias("position"))
    schema = "position bigint, doc_id bigint, ids array<bigint>"
    fields = arrow_fields(schema)

    def pick(files: pa.Table, places: pa.Table) -> pa.Table:
        content = memoryview(files.column("content")[0].as_buffer())
        rows = []
        for at, n, position in zip(*(places.column(c).to_pylist() for c in ("offset", "length", "position"))):
            _proven([bytes(content[at + 12 : at + 12 + n])], [struct.unpack_from(_CRC, content, at + 12 + n)[0]])
            key, ids = _record(content, at, n)
            rows.append((position, key, ids))
        return pa.Table.from_batches([table_of(rows, fields)])

    picked = _files(spark, folder).groupBy("file").cogroup(wanted.groupBy("file")).applyInArrow(pick, schema)
    return picked.repartitionByRange("position").sortWithinPartitions("position")


def folder_for(spark: SparkSession) -> str:
    """A new folder in the shared one."""
    return intermediate_path(spark, "records")
