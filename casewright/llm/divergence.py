"""How far each source's choice of words is from the other sources of its language, and from the language as a whole.

Term counts come from single-pass in-memory indexing. A task reads its documents once, keeps the postings of a block of
at most ``BLOCK_WORDS`` words in memory, and spills the block as runs sorted by term, cut into hash shards of terms and
into chunks. A shard's task takes its chunks in the order of their first terms and merges the runs with a heap: all
postings below the next chunk's first term are complete, so it holds one open chunk of each run at most. A term's sources,
counts and documents are summed there, and terms in too few documents go. ``frequencies`` is that result.

``divergences`` compares smoothed relative frequencies ``p`` in integers. Where neither of two sources has a term, all
terms give the same value; where one has it, the value depends on its ``p`` alone, so a histogram of ``p`` for each source
is enough; only terms that both have need a correction of their own. The shards stream those corrections, summed over a
shard's terms for each pair of sources that meet there. So the work follows the postings, not terms x sources.

Defined results: a null text, language or source is ''; a group without terms is still a group; a language without kept
terms has value 0 for each pair; equal values rank by the item's UTF-8 bytes; repeated rows count each; an empty table
gives an empty one; other columns are not read. Texts of any length are read in slices.
"""

from __future__ import annotations

import heapq
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright.llm.shared import cut_lineage
from casewright.session import parallelism

#: Words of a block in memory, and the bytes of text that are split at once.
BLOCK_WORDS, SLICE_BYTES = 3_000_000, 4 << 20
#: Postings of a chunk of a run.
CHUNK = 4096
#: Postings that a merging task takes up before it sums the complete ones.
HELD = 400_000
LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000

RUNS = "shard int, lang string, first binary, terms array<binary>, sources array<string>, counts array<bigint>, docs array<bigint>"
FREQUENCIES = "shard int, lang string, source string, term string, n bigint, total bigint, first boolean"

# bytes of terms stand for themselves, A-Z in lower case; all others are blanks
_TABLE = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BLANK = re.compile(rb" ")


class _Numbers(dict):
    """Numbers things in the order of their first sight."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _slices(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, in slices that end between terms."""
    plain, at = text.translate(_TABLE), 0
    while len(plain) - at > SLICE_BYTES:
        found = _BLANK.search(plain, at + SLICE_BYTES)
        end = found.start() if found else len(plain)
        yield plain[at:end].split()
        at = end
    yield (plain[at:] if at else plain).split()


class Block:
    """Postings of documents in memory, until they are handed out as sorted runs."""

    def __init__(self, shards: int):
        self.shards = shards
        self.clear()

    def clear(self) -> None:
        self.terms, self.groups, self.words = _Numbers(), _Numbers(), 0
        self.parts: list[tuple[int, np.ndarray, np.ndarray]] = []

    def add(self, text: bytes, lang: str, source: str) -> None:
        group, number, several = self.groups[lang, source], self.terms.__getitem__, []
        for terms in _slices(text):
            if terms:
                several.append(np.unique(np.fromiter(map(number, terms), dtype=np.int64, count=len(terms)), return_counts=True))
        if several:
            ids, counts = several[0] if len(several) == 1 else _summed(np.concatenate([s[0] for s in several]), np.concatenate([s[1] for s in several]))[:2]
            self.parts.append((group, ids, counts))
            self.words += len(ids)

    def runs(self) -> Iterator[pa.RecordBatch]:
        """Chunks of every language and shard, in order; a group is marked by the empty term."""
        groups, terms = list(self.groups), list(self.terms)
        order = sorted(range(len(terms)), key=terms.__getitem__)
        place = np.empty(len(terms) + 1, dtype=np.int64)  # the empty term, last by number, is first by order
        place[order] = np.arange(1, len(terms) + 1)
        place[-1] = 0
        shard_of = np.array([zlib.crc32(t) % self.shards for t in terms] + [zlib.crc32(b"") % self.shards], dtype=np.int64)
        marks = np.arange(len(groups))
        ids = np.concatenate([*(p[1] for p in self.parts), np.full(len(groups), len(terms))]).astype(np.int64)
        group = np.concatenate([np.repeat([p[0] for p in self.parts], [len(p[1]) for p in self.parts]), marks]).astype(np.int64)
        counts = np.concatenate([*(p[2] for p in self.parts), np.zeros(len(groups), dtype=np.int64)])
        self.clear()
        by_name = np.empty(len(groups), dtype=np.int64)
        by_name[sorted(marks.tolist(), key=groups.__getitem__)] = marks
        # (term, group) in the order of terms and then of names
        key, count, documents = _summed(place[ids] * len(groups) + by_name[group], counts)
        named = sorted(groups)
        langs = {lang: k for k, lang in enumerate(dict.fromkeys(g[0] for g in named))}
        lang_of = np.array([langs[g[0]] for g in named], dtype=np.int64)
        term, group = key // len(groups), key % len(groups)
        number = np.array([len(terms), *order], dtype=np.int64)[term]
        where = shard_of[number] * len(langs) + lang_of[group]
        at = np.argsort(where, kind="stable")
        all_terms, all_sources = pa.array([*terms, b""], pa.binary()), pa.array([g[1] for g in named], pa.string())
        starts = np.flatnonzero(np.diff(where[at], prepend=-1))
        cuts = np.concatenate([np.arange(a, b, CHUNK) for a, b in zip(starts, [*starts[1:], len(at)])])
        offsets = np.append(cuts, len(at)).astype(np.int32)
        names = list(langs)
        listed = lambda values: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array(where[at][cuts] // len(langs), pa.int32()),
                pa.array([names[k] for k in where[at][cuts] % len(langs)], pa.string()),
                all_terms.take(pa.array(number[at][cuts])),
                listed(all_terms.take(pa.array(number[at]))),
                listed(all_sources.take(pa.array(group[at]))),
                listed(pa.array(count[at])),
                listed(pa.array(documents[at])),
            ],
            names=["shard", "lang", "first", "terms", "sources", "counts", "docs"],
        )
        for k in range(0, batch.num_rows, 256):
            yield batch.slice(k, 256)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the sums of their values, and their counts."""
    at = np.argsort(keys, kind="stable")
    keys = keys[at]
    starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return keys[starts], np.add.reduceat(values[at], starts), np.diff(starts, append=len(keys))


class Merge:
    """Merges the sorted chunks of one shard, which come in the order of (language, first term)."""

    def __init__(self, least: int):
        self.least, self.heap, self.taken, self.size, self.lang, self.seen = least, [], [], 0, None, 0

    def add(self, lang: str, terms, sources, counts, docs) -> Iterator[tuple]:
        if lang != self.lang:
            yield from self.finish()
            self.lang = lang
        if self.size >= HELD:
            yield from self._below(terms[0])
        heapq.heappush(self.heap, (terms[0], self.seen, 0, terms, sources, counts, docs))
        self.seen += 1
        self.size += len(terms)

    def _below(self, bound: bytes | None) -> Iterator[tuple]:
        """Sums all postings of terms below ``bound``, or all there are."""
        heap, taken = self.heap, []
        while heap and (bound is None or heap[0][0] < bound):
            _, run, start, terms, sources, counts, docs = heapq.heappop(heap)
            end = len(terms) if bound is None else bisect_left(terms, bound, start)
            taken.append((terms[start:end], sources[start:end], counts[start:end], docs[start:end]))
            if end < len(terms):
                heapq.heappush(heap, (terms[end], run, end, terms, sources, counts, docs))
        if taken:
            self.size -= sum(len(t[0]) for t in taken)
            yield self._sums(*(np.concatenate([t[k] for t in taken]) if k > 1 else [x for t in taken for x in t[k]] for k in range(4)))

    def _sums(self, terms: list[bytes], sources: list[str], counts: np.ndarray, docs: np.ndarray):
        term, source = (pa.array(x).dictionary_encode() for x in (terms, sources))
        codes, places = (x.indices.to_numpy().astype(np.int64) for x in (term, source))
        n_terms, n_sources = len(term.dictionary), len(source.dictionary)
        together = np.zeros(n_terms, dtype=np.int64)
        np.add.at(together, codes, docs)
        marks = np.array([t == b"" for t in term.dictionary.to_pylist()])
        kept = (together >= self.least) | marks
        if not kept.any():
            return None
        chosen = kept[codes]
        key, n, _ = _summed(codes[chosen] * n_sources + places[chosen], counts[chosen])
        code, place = key // n_sources, key % n_sources
        first = np.diff(code, prepend=-1) != 0
        total = np.zeros(n_terms, dtype=np.int64)
        np.add.at(total, code, n)
        return (
            pa.array([self.lang] * len(key), pa.string()), source.dictionary.take(pa.array(place)),
            term.dictionary.take(pa.array(code)).cast(pa.string()), pa.array(n), pa.array(total[code]), pa.array(first),
        )

    def finish(self) -> Iterator[tuple]:
        yield from self._below(None)


def frequencies(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``FREQUENCIES``: counts of each kept term in each (language, source) that has it, ``total`` in the language,
    ``first`` on one row of each (language, term). A row with the empty term stands for each group."""
    shards = parallelism(docs.sparkSession)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(blank(text).cast("binary").alias("a"), blank(lang).alias("b"), blank(source).alias("c"))

    def index(batches):
        block = Block(shards)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    block.add(*row)
                    if block.words >= BLOCK_WORDS:
                        yield from block.runs()
        if block.groups:
            yield from block.runs()

    def merge(batches):
        shard, merging = -1, Merge(least)

        def told(found):
            return pa.RecordBatch.from_arrays([pa.array([shard] * len(found[0]), pa.int32()), *found], names=["shard", "lang", "source", "term", "n", "total", "first"])

        for batch in batches:
            lists = [batch.column(k) for k in range(3, 7)]
            for i in range(batch.num_rows):
                if (now := batch.column(0)[i].as_py()) != shard:
                    yield from (told(f) for f in merging.finish() if f)
                    shard, merging = now, Merge(least)
                terms, sources, counts, documents = (c[i].values for c in lists)
                chunk = terms.to_pylist(), sources.to_pylist(), counts.to_numpy(), documents.to_numpy()
                yield from (told(f) for f in merging.add(batch.column(1)[i].as_py(), *chunk) if f)
        yield from (told(f) for f in merging.finish() if f)

    runs = rows.mapInArrow(index, RUNS).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "lang", "first")
    return runs.mapInArrow(merge, FREQUENCIES)


def _share(count: Column, n: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (n + 2 * terms)), exactly; the product leaves 64 bits only for large counts."""
    size = n + 2 * terms
    wide = F.call_function("div", (count + 2).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)"), size.cast("decimal(19,0)"))
    return 1 + F.when(count < (1 << 62) // SCALE, F.call_function("div", (count + 2) * F.lit(SCALE).cast("bigint"), size)).otherwise(wide)


def _distance(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / (p + q)); both are below 2**30 + 1, so the square is exact."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _corrections(terms: np.ndarray, sources: np.ndarray, p: np.ndarray, zero: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of sources (by number, the smaller first) that share a term, and what their shared terms add to the sum of
    the values that hold where one of the two lacks the term. Rows are sorted by (term, source)."""
    at, step, keys, sums = np.arange(len(terms)), 1, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    size = int(sources.max()) + 1
    while True:
        at = at[at + step < len(terms)]
        at = at[terms[at] == terms[at + step]]
        if not len(at):
            return keys // size, keys % size, sums
        a, b = at, at + step
        added = _distances(p[a], p[b]) - _distances(p[a], zero[b]) - _distances(zero[a], p[b]) + _distances(zero[a], zero[b])
        keys, sums, _ = _summed(np.concatenate([keys, sources[a] * size + sources[b]]), np.concatenate([sums, added]))
        step += 1


def divergences(frequency: DataFrame, top: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank``: each group against the other sources of its language (part ``pair``, all
    of them) and its ``top`` terms that it uses more than its language does (part ``term``)."""
    terms = frequency.where("term <> ''")
    langs = terms.where("first").groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_n"))
    sizes = terms.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = frequency.where("term = ''").select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["size", "terms", "lang_n"])
    # p of a term that the group does not have
    groups = cut_lineage(groups.withColumn("zero", F.when(F.col("terms") > 0, _share(F.lit(0).cast("bigint"), F.col("size"), F.col("terms")))))
    shares = cut_lineage(
        terms.join(groups, ["lang", "source"]).select(
            "shard", "lang", "source", "term", "zero", _share(F.col("n"), F.col("size"), F.col("terms")).alias("p"),
            _share(F.col("total"), F.col("lang_n"), F.col("terms")).alias("q"),
        )
    )
    by_value = lambda item: Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc(item))
    above = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value"))
    best = above.withColumn("rank", F.row_number().over(by_value("item"))).where(F.col("rank") <= top)

    other = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("other_zero"))
    # the result has every pair of a language's sources
    pairs = groups.join(other, "lang").where("source <> item")
    none = _distance(F.col("zero"), F.col("other_zero"))
    base = pairs.select("lang", "source", "item", F.coalesce(F.col("terms") * none, F.lit(0)).alias("value"))
    histogram = shares.groupBy("lang", "source", "zero", "p").agg(F.count(F.lit(1)).alias("m"))
    one = histogram.join(other, "lang").where("source <> item")
    one = one.groupBy("lang", "source", "item").agg(F.sum(F.col("m") * (_distance(F.col("p"), F.col("other_zero")) - none)).alias("value"))

    def correct(found: pa.Table) -> pa.Table:
        found = found.sort_by([("term", "ascending"), ("source", "ascending")])
        term, source = (found.column(c).combine_chunks().dictionary_encode() for c in ("term", "source"))
        names = source.dictionary.to_pylist()
        order = {name: k for k, name in enumerate(sorted(names))}
        numbers = np.array([order[name] for name in names], dtype=np.int64)[source.indices.to_numpy()]
        a, b, sums = _corrections(term.indices.to_numpy(), numbers, found.column("p").to_numpy(), found.column("zero").to_numpy())
        ordered = pa.array(sorted(names), pa.string())
        return pa.table({"lang": pa.array([found.column("lang")[0].as_py()] * len(a), pa.string()), "source": ordered.take(pa.array(a)), "item": ordered.take(pa.array(b)), "value": pa.array(sums)})

    both = shares.select("shard", "lang", "source", "term", "zero", "p").groupBy("shard", "lang").applyInArrow(correct, "lang string, source string, item string, value bigint")
    both = both.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    half = one.unionByName(both)
    mirrored = half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    summed = base.unionByName(half).unionByName(mirrored).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    ranked = summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value("item")).alias("rank"))
    return ranked.unionByName(best)


def audit(docs: DataFrame) -> DataFrame:
    """``divergences`` of the table's ``frequencies``."""
    return divergences(cut_lineage(frequencies(docs)))
