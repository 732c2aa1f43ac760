"""Record files: checksums by the bit, round trips against the tokenizers library, shuffled reads, every odd input."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casewright.llm import records

PATH = public_tokenizers.path("word_bpe_49k.json")


def slow_masked(data):
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b
        for _ in range(8):
            crc = crc >> 1 ^ (records.POLYNOMIAL if crc & 1 else 0)
    crc ^= 0xFFFFFFFF
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def test_checksums_by_the_bit():
    rng = random.Random(1)
    parts = [rng.randbytes(n) for n in (4, 5, 7, 8, 255, 256, 257, 258, 511, 512, 513, 5000)]
    assert records.masked_checksums(parts) == [slow_masked(p) for p in parts]
    # the public check value of CRC-32C
    crc = (records.masked_checksums([b"123456789"])[0] - 0xA282EAD8) & 0xFFFFFFFF
    assert (crc >> 17 | crc << 15) & 0xFFFFFFFF == 0xE3069283


def test_blocks_are_records(monkeypatch):
    monkeypatch.setattr(records, "BLOCK_BYTES", 40)
    rows = [(i, "x" * i) for i in range(30)]
    got = b"".join(b + b"\0" for b in records.blocks(iter(rows), lambda k, t: struct.pack("<qI", k, 0) + t.encode()))
    at, seen = 0, []
    while at < len(got):
        n = struct.unpack_from("<Q", got, at)[0]
        payload = got[at + 12 : at + 12 + n]
        assert struct.unpack_from("<I", got, at + 8)[0] == slow_masked(got[at : at + 8])
        assert struct.unpack_from("<I", got, at + 12 + n)[0] == slow_masked(payload)
        seen.append(payload)
        at += n + 16
    assert at == len(got) and [p[12:] for p in seen[:-1]] == [t.encode() for _, t in rows]
    assert list(records.blocks(iter(()), None)) == []


def brute(rows):
    """(doc_id, start, n_tokens, crc) by the library, in order of id."""
    library = Tokenizer.from_file(PATH)
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def written(spark, df, **more):
    folder = records.folder_for(spark)
    records.write(df, PATH, folder, **more)
    return folder


@pytest.mark.parametrize("file_bytes", [1 << 24, 3000])
def test_round_trip(spark, make_docs, odd_texts, file_bytes):
    rng = random.Random(3)
    letters = ["a", "Ab", "don't", "é", "İ", "ß", "½", "7", " ", "\t", "\x85", "_", "<|endoftext|>", "<|startoftext|>", "…", "日本", "é", " ", "'S", "#", "\U0001f600"]
    letters += ["Ⱥ", "ǅ", "ª", "µ", "Ÿ", "ʼn", "'re", "'l", "×", "€", "²"]
    texts = odd_texts + ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(900)]
    docs = make_docs(texts)
    folder = written(spark, docs.orderBy(F.desc("doc_id")), file_bytes=file_bytes)
    got = sorted(map(tuple, records.read(spark, folder).collect()))
    assert got == sorted(brute(list(enumerate(texts))))
    index = records.index(spark, folder).orderBy("file", "offset").collect()
    assert [r["doc_id"] for r in index] == list(range(len(texts)))  # files and offsets are in order of the ids
    if file_bytes == 3000:
        assert len({r["file"] for r in index}) > 10


def test_repeated_and_null_ids_and_empty_table(spark, make_docs):
    docs = make_docs(["b c", None, "x", "x"])
    odd = docs.unionByName(docs).unionByName(docs.withColumn("doc_id", F.lit(None).cast("bigint")))
    got = records.read(spark, written(spark, odd)).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None] * 4 + [0, 0, 1, 1, 2, 2, 3, 3]
    ends = [r["start"] + r["n_tokens"] for r in got]
    assert [r["start"] for r in got] == [0, *ends[:-1]]
    assert sorted((r["n_tokens"], r["ids_crc32"]) for r in got if r["doc_id"] is not None) == sorted(x[2:] for x in brute([(i % 4, t) for i, t in enumerate(["b c", None, "x", "x"] * 2)]))
    assert records.read(spark, written(spark, docs.where("false"))).count() == 0


def test_one_hot_id_is_dealt_over_files(spark):
    df = spark.range(3000).select(F.lit(7).alias("doc_id"), F.lit("same text again").alias("text"))
    folder = written(spark, df, file_bytes=8000)
    sizes = [r["n"] for r in records.index(spark, folder).groupBy("file").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1500


def test_shuffled_read(spark, make_docs, odd_texts):
    folder = written(spark, make_docs(odd_texts * 3), file_bytes=3000)
    library = Tokenizer.from_file(PATH)
    rows = records.shuffled(spark, folder, 5).orderBy("position").collect()
    assert {r["doc_id"]: list(r["ids"]) for r in rows} == {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(odd_texts * 3)}
    order = [r["doc_id"] for r in rows]
    again = [r["doc_id"] for r in records.shuffled(spark, folder, 5).orderBy("position").collect()]
    other = [r["doc_id"] for r in records.shuffled(spark, folder, 6).orderBy("position").collect()]
    assert order == again and order != other and order != sorted(order)


def test_a_changed_byte_is_found():
    payload = struct.pack("<qBBH", 1, 0, 2, 0) + b"\x05\x00"
    frame = records.frames([payload])[0]
    records._proven([frame[12:-4]], [struct.unpack("<I", frame[-4:])[0]])
    with pytest.raises(ValueError):
        records._proven([frame[12:-5] + b"\x01"], [struct.unpack("<I", frame[-4:])[0]])
