"""Exact top-k search: BM25 over an inverted index with block-max WAND.

The index is a written table of a row for each shard. A shard is a run of rows of one input partition; for each of its
terms it has the postings in order of row, and all of them are one value of bytes, so that walking a shard again costs no
exchange. Document frequencies, the number of documents and their mean length are global, so a shard's scores are final
and the shards' best merge exactly. Queries of equal terms are walked once, and only lists that some query asks for are read.

A shard is walked by block-max WAND for many queries at once. Its rows fall into blocks of ``BLOCK``, and every list has
its largest weight in each block. The sums of these bound what a query can score in a block; a query's pivot is the next
block whose bound reaches its k-th best score so far, and the blocks before it are skipped. The queries that have their
pivot in a block score its rows together: long lists are columns of a matrix and give bounds and scores by products with
the queries' terms, short lists are added posting by posting. ``walk`` is the same walk for one query, row by row.

Shards are walked in rounds, each of which starts from the k-th best scores found before it. Queries go to the
executors in blocks of ``QUERY_BLOCK``, so that no row is made for each query and shard.

A query is the text of a row, with all of its distinct terms: BM25 of the whole text. A caller can ask for a
more-like-this search instead, by the ``terms`` distinct ones of the highest tf·idf (ties go to the smaller
term), which ranks and scores a longer text by that part of it alone. Scores are rounded to six decimals before they
are ranked.

Defined results: terms are runs of letters and digits in lower case; a null text has none; a query without terms, or
none of whose terms is in another row, has no result; a row is no result for its own id; an id is one result, with
its best row; repeated query ids are one query, by the smallest text; rows with a null id are counted, but are neither
queries nor results; ties go to the smaller id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from casewright.llm.shared import cut_lineage

K1, B = 1.2, 0.75
TERMS = 25
#: Documents and words in a shard at most; a longer document is a shard of its own. Rows in a block.
SHARD_ROWS, SHARD_WORDS = 2048, 1_500_000  # a row has 16 bits in a list
BLOCK = 64
#: Terms that are sent to every executor at most, some 30 MB.
BROADCAST_TERMS = 1_000_000
#: Queries, of ``QUERY_TERMS`` terms each, that are sent to every executor and walked together; fewer if they are longer.
QUERY_BLOCK, QUERY_TERMS = 8192, 128
#: Queries that a task scores at once. A long list holds more than this share of a shard's rows; the matrix of the long
#: lists has so many cells and lists at most, and the longest come first.
TOGETHER, LONG, CELLS, LONG_LISTS = 512, 1 / 32, 4_000_000, 4096
#: Postings of short lists that a task gathers at once, about.
GATHERED = 4_000_000
#: How many times as many shards as in all rounds before it a round walks.
GROWTH = 4
_TERM = re.compile(r"[^\W_]+")

#: Of a shard: its terms and the length of each one's list, as an Arrow stream; the lists, one after the other, each its
#: rows and then their frequencies, as bytes; its documents.
POSTINGS = "shard bigint, terms binary, lists binary, documents array<struct<id bigint, words int>>"
_DOCUMENTS = pa.list_(pa.struct([("id", pa.int64()), ("words", pa.int32())]))
NEAR = "class bigint, doc_id bigint, score double"


def terms_of(text: str | None) -> list[str]:
    return _TERM.findall((text or "").lower())


class Shard:
    def __init__(self):
        self.numbers: dict[str, int] = {}
        self.words: list[np.ndarray] = []
        self.ids: list[int | None] = []

    def add(self, doc_id: int | None, text: str | None) -> int:
        numbers = self.numbers
        at = [numbers.setdefault(t, len(numbers)) for t in terms_of(text)]
        self.words.append(np.array(at, dtype=np.int64))
        self.ids.append(doc_id)
        return len(at)

    def batch(self, shard: int) -> pa.RecordBatch:
        lengths = np.array([len(w) for w in self.words])
        terms = list(self.numbers)
        rows = np.repeat(np.arange(len(lengths)), lengths)
        keys, tfs = np.unique(np.concatenate(self.words) * len(lengths) + rows, return_counts=True)
        term, row = np.divmod(keys, len(lengths))
        begin = np.searchsorted(term, np.arange(len(terms) + 1))

        counts = np.diff(begin)
        # rows of two bytes and frequencies of four, list after list
        packed, at = np.zeros(6 * len(row), dtype=np.uint8), 6 * np.repeat(begin[:-1], counts)
        inside = np.arange(len(row)) - np.repeat(begin[:-1], counts)
        for values, width, start in ((row.astype("<u2"), 2, at), (tfs.astype("<u4"), 4, at + 2 * np.repeat(counts, counts))):
            places = (start + width * inside)[:, None] + np.arange(width)
            packed[places] = values.view(np.uint8).reshape(-1, width)
        documents = [{"id": i, "words": w} for i, w in zip(self.ids, lengths.tolist())]
        named = pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(counts, pa.int32())], names=["term", "n"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, named.schema) as out:
            out.write_batch(named)
        blobs = [pa.array([x], pa.large_binary()).cast(pa.binary()) for x in (sink.getvalue().to_pybytes(), packed.tobytes())]
        return pa.RecordBatch.from_arrays([pa.array([shard]), *blobs, pa.array([documents], _DOCUMENTS)], names=["shard", "terms", "lists", "documents"])


def _terms_in(blob: pa.Scalar) -> pa.RecordBatch:
    """``(term, n)`` of a shard."""
    with pa.ipc.open_stream(blob.as_buffer()) as stream:
        return stream.read_next_batch()


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``POSTINGS`` of every row, as a written table."""
    source = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))

    def run(batches):
        base, n, shard, words = TaskContext.get().partitionId() << 32, 0, Shard(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for key, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words += shard.add(key, body)
                    if len(shard.ids) >= SHARD_ROWS or words >= SHARD_WORDS:
                        yield shard.batch(base + n)
                        n, shard, words = n + 1, Shard(), 0
        if shard.ids:
            yield shard.batch(base + n)

    return cut_lineage(source.mapInArrow(run, POSTINGS))


def query_terms(docs: DataFrame, postings: DataFrame, total: int, doc_id: str, text: str, terms: int | None = TERMS) -> DataFrame:
    """``(query_id, term, idf)``: each query row's most distinctive terms, or all of them. ``docs`` are the query rows only."""
    one = docs.select(F.col(doc_id).cast("bigint").alias("query_id"), F.col(text).alias("text")).groupBy("query_id").agg(F.min("text").alias("text"))

    def run(batches):
        for batch in batches:
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names, tfs = np.unique(np.array(terms_of(body), dtype=object), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(names), key)), pa.array(names.tolist(), pa.string()), pa.array(tfs, pa.int64())], names=["query_id", "term", "tf"])

    own = cut_lineage(one.mapInArrow(run, "query_id bigint, term string, tf bigint"))

    def lengths(batches):
        for batch in batches:
            for blob in batch.column(0):
                named = _terms_in(blob)
                for at in range(0, named.num_rows, 20_000):
                    yield named.slice(at, 20_000)

    each = postings.select("terms").mapInArrow(lengths, "term string, n int")
    counts = _of_terms(each, own.select("term")).groupBy("term").agg(F.sum("n").alias("df"))
    idf = F.log(1 + (F.lit(float(total)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    scored = own.join(counts, "term").withColumn("idf", idf)
    if terms is None:
        return cut_lineage(scored.select("query_id", "term", "idf"))
    best = Window.partitionBy("query_id").orderBy(F.round(F.col("tf") * F.col("idf"), 9).desc(), "term")
    scored = scored.withColumn("r", F.row_number().over(best))
    return cut_lineage(scored.where(F.col("r") <= terms).select("query_id", "term", "idf"))


def _of_terms(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """The lists of ``terms``, which are broadcast if their counted number is small, else joined by a shuffle."""
    wanted = cut_lineage(terms.distinct())
    return postings.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_TERMS else wanted, "term")


class List:
    """One term's postings in a shard, with a cursor."""

    __slots__ = ("at", "blocks", "bounds", "idf", "now", "rows", "tfs", "top")

    def __init__(self, idf: float, rows: list[int], tfs: list[int], bounds: list[float]):
        self.idf, self.rows, self.tfs, self.bounds = idf, rows, tfs, bounds
        self.top, self.at, self.now = max(bounds), 0, rows[0]

    def seek(self, row: int) -> None:
        """Move to the first posting at or after ``row``."""
        self.at = bisect_left(self.rows, row, self.at)
        self.now = self.rows[self.at] if self.at < len(self.rows) else _END

    def block(self, row: int) -> tuple[float, int]:
        """Bound of the block that would hold ``row``, and the block's last row. The cursor stays."""
        at = bisect_left(self.rows, row, self.at) // BLOCK
        if at >= len(self.bounds):
            return 0.0, _END
        return self.bounds[at], self.rows[min((at + 1) * BLOCK, len(self.rows)) - 1]


_END = 1 << 40


def weight(idf: float, tf: float, length: float, mean: float) -> float:
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def walk(lists: list[List], ids: list, lengths: list[int], mean: float, k: int, least: float = 0.0) -> list[tuple[float, int]]:
    """The k best ids of a shard with their scores, by block-max WAND. Ties go to the smaller id.

    Documents below ``least``, a k-th best score from elsewhere, may be left out.
    """
    heap: list[tuple[float, int]] = []  # (score, -id), the worst first
    best: dict[int, float] = {}
    least = max(0.0, least - 2e-6)  # bounds are not rounded
    while True:
        lists = [x for x in lists if x.now != _END]
        if not lists:
            break
        lists.sort(key=lambda x: x.now)
        bound, p = 0.0, 0
        for p, x in enumerate(lists):
            bound += x.top
            if bound >= least:
                break
        else:
            break
        pivot = lists[p].now
        while p + 1 < len(lists) and lists[p + 1].now == pivot:
            p += 1
        blocks = [x.block(pivot) for x in lists[: p + 1]]
        if sum(b for b, _ in blocks) < least:
            # no document up to the end of the shortest of these blocks, or to the next list, can reach the least
            after = min(min(e for _, e in blocks) + 1, lists[p + 1].now if p + 1 < len(lists) else _END)
            after = max(after, pivot + 1)
            for x in lists[: p + 1]:
                if x.now < after:
                    x.seek(after)
        elif lists[0].now == pivot:
            here = [x for x in lists[: p + 1] if x.now == pivot]
            score = round(sum(weight(x.idf, x.tfs[x.at], lengths[pivot], mean) for x in here), 6)
            key = ids[pivot]
            if key is not None and score >= least:
                if key in best:
                    if score > best[key]:
                        heap.remove((best[key], -key))
                        heapq.heapify(heap)
                        heapq.heappush(heap, (score, -key))
                        best[key] = score
                elif len(heap) < k:
                    heapq.heappush(heap, (score, -key))
                    best[key] = score
                elif (score, -key) > heap[0]:
                    gone = heapq.heapreplace(heap, (score, -key))
                    best.pop(-gone[1])
                    best[key] = score
                if len(heap) == k:
                    least = max(least, heap[0][0] - 2e-6)
            for x in here:
                x.seek(pivot + 1)
        else:
            for x in lists[:p]:
                if x.now < pivot:
                    x.seek(pivot)
    return sorted(((s, -i) for s, i in heap), key=lambda x: (-x[0], x[1]))


class Asked:
    """The queries of a block: their classes, and the distinct terms of each by their place in ``vocabulary``, one query after the other.

    They stay Arrow and numpy arrays: a million terms as objects would fill the driver.
    """

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        lists, idfs = (pa.concat_arrays(rows[c].chunks) for c in ("term", "idf"))
        coded = lists.flatten().dictionary_encode()
        self.classes, self.vocabulary, self.terms = rows["class"].to_numpy(), coded.dictionary, coded.indices.to_numpy()
        self.ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        self.idf = np.zeros(len(self.vocabulary))
        self.idf[self.terms] = idfs.flatten().to_numpy(zero_copy_only=False)  # one value a term


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, …``, ``counts[i]`` of them, for each i."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def walk_blocks(rows, weights, begin, ids, queries, ends, least, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(query, ids, scores)``: the k best ids of a shard for each query, by block-max WAND. Ties go to the smaller id.

    List i has the postings ``begin[i]`` to ``begin[i + 1]``. ``queries`` are numbers of lists, one query after the other
    up to ``ends``. Rows with a null id are no results; documents below ``least`` of a query may be left out.
    """
    named = np.array([i is not None for i in ids], dtype=bool)
    ids = np.array([0 if i is None else i for i in ids], dtype=np.int64)
    distinct = len(np.unique(ids[named])) == named.sum()
    n, counts, n_blocks = len(ids), np.diff(begin), -(-len(ids) // BLOCK)
    width = n_blocks * BLOCK
    longest = np.argsort(-counts, kind="stable")[: min(LONG_LISTS, CELLS // width)]
    longest = longest[counts[longest] > n * LONG]
    place = np.full(len(counts), -1)
    place[longest] = np.arange(len(longest))
    matrix, at = np.zeros((len(longest), width)), _ranges(begin[longest], counts[longest])
    matrix[np.repeat(np.arange(len(longest)), counts[longest]), rows[at]] = weights[at]
    most = matrix.reshape(len(longest), n_blocks, BLOCK).max(axis=2, initial=0)
    starts = np.concatenate([[0], ends[:-1]])
    sizes = np.concatenate([[0], np.cumsum(np.where(place[queries] < 0, counts[queries], 0))])
    first = 0
    while first < len(ends):
        # as many queries as gather about so many postings
        last = int(np.searchsorted(sizes[ends], sizes[starts[first]] + GATHERED, "right"))
        last = min(max(last, first + 1), first + TOGETHER, len(ends))
        own = queries[starts[first] : ends[last - 1]]
        of = np.repeat(np.arange(last - first), (ends - starts)[first:last])
        has = np.zeros((last - first, len(longest)))
        is_long = place[own] >= 0
        has[of[is_long], place[own[is_long]]] = 1.0
        short, of = own[~is_long], of[~is_long]
        at = _ranges(begin[short], counts[short])
        part = np.bincount(np.repeat(of * width, counts[short]) + rows[at], weights[at], (last - first) * width)
        part = part.reshape(last - first, width)
        bounds = has @ most + part.reshape(last - first, n_blocks, BLOCK).max(axis=2)
        floor = np.maximum(least[first:last], 2e-6)  # a row without a term of the query scores -1
        best = np.full((last - first, k), -1.0)  # each query's k best scores so far, in no order
        found: list[tuple] = []
        for block in range(n_blocks):
            here = np.flatnonzero((bounds[:, block] > 0) & (bounds[:, block] >= floor - 2e-6))  # bounds are not rounded
            if not len(here):
                continue
            span = slice(block * BLOCK, min((block + 1) * BLOCK, n))
            scores = has[here] @ matrix[:, span] + part[here, span]
            scores = np.where((scores > 0) & named[span], np.round(scores, 6), -1.0)
            q, row = np.nonzero(scores >= floor[here, None] - 2e-6)
            found.append((here[q], row + span.start, scores[q, row]))
            if distinct:  # several rows of an id are one result, and would count twice
                better = here[scores.max(axis=1) > best[here].min(axis=1)]
                some = np.hstack([best[better], scores[np.searchsorted(here, better)]])
                best[better] = -np.partition(-some, k - 1, axis=1)[:, :k]
                floor[better] = np.maximum(floor[better], best[better].min(axis=1))
        if found:
            q, row, score = (np.concatenate(x) for x in zip(*found))
            kept = score >= floor[q] - 2e-6
            q, row, score = q[kept], row[kept], score[kept]
            key = ids[row]
            order = np.lexsort((key, -score, q))
            q, key, score = q[order], key[order], score[order]
            cuts = np.flatnonzero(np.diff(q)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(q)] if len(q) else []):
                mine = slice(lo, hi)
                if not distinct:
                    mine = lo + np.sort(np.unique(key[mine], return_index=True)[1])
                yield first + int(q[lo]), key[mine][:k], score[mine][:k]
        first = last


def _walked(asked, least, mean: float, k: int):
    """Walk shards for every query of the block that has one of their terms: the k best of each that reach its least score.

    k is one more than asked for, as each query leaves out its own id.
    """

    def walked(asks: Asked, floors: np.ndarray, terms: pa.Scalar, lists: pa.Scalar, documents: pa.Scalar) -> pa.RecordBatch | None:
        named = _terms_in(terms)
        rows_of = documents.values
        ids, lengths = rows_of.field("id").to_pylist(), rows_of.field("words").to_numpy().astype(float)
        # the shard has fewer terms than the queries, as a rule, and so the smaller table to look them up in
        found = pc.index_in(asks.vocabulary, value_set=named["term"])
        number = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        if not len(number):
            return None
        chosen = found.drop_null().to_numpy().astype(np.int64)
        counts = named["n"].to_numpy().astype(np.int64)
        starts = 6 * (np.cumsum(counts) - counts)[chosen]
        counts, packed = counts[chosen], np.frombuffer(lists.as_buffer(), np.uint8)
        two, four = packed[_ranges(starts, 2 * counts)], packed[_ranges(starts + 2 * counts, 4 * counts)]
        rows, tfs = two.view("<u2").astype(np.int64), four.view("<u4").astype(float)
        begin = np.concatenate([[0], np.cumsum(counts)])
        weights = weight(np.repeat(asks.idf[number], counts), tfs, lengths[rows], mean)
        place = np.full(len(asks.idf), -1)
        place[number] = np.arange(len(number))
        held = place[asks.terms] >= 0
        ends = np.concatenate([[0], np.cumsum(held)])[asks.ends]
        out = list(walk_blocks(rows, weights, begin, ids, place[asks.terms[held]], ends, floors, k))
        if not out:
            return None
        classes = np.repeat(asks.classes[[q for q, _, _ in out]], [len(i) for _, i, _ in out])
        return pa.RecordBatch.from_arrays([pa.array(classes), pa.array(np.concatenate([i for _, i, _ in out])), pa.array(np.concatenate([s for _, _, s in out]))], names=["class", "doc_id", "score"])

    def run(batches):
        asks, floors = asked.value, None
        for batch in batches:
            if floors is None:
                floors = np.array([least.value.get(c, 0.0) for c in asks.classes.tolist()])
            for shard in zip(*(batch.column(i) for i in range(3))):
                near = walked(asks, floors, *shard)
                if near is not None:
                    yield near

    return run


def search(docs: DataFrame, every: int, k: int, doc_id: str = "doc_id", text: str = "text", terms: int | None = None) -> DataFrame:
    """For each row whose id is divisible by ``every``: ``(query_id, rank, doc_id, score)`` of its ``k`` best others."""
    postings = index(docs, doc_id, text)
    totals = postings.agg(F.count(F.lit(1)).alias("shards"), F.sum(F.size("documents")).alias("n"), F.sum(F.aggregate("documents.words", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("words")).head()
    total, words = totals["n"] or 0, totals["words"] or 0
    mean = words / total if words else 1.0
    asked = query_terms(docs.where(F.col(doc_id).cast("bigint") % every == 0), postings, total, doc_id, text, terms)
    whole = asked.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("term", "idf"))).alias("terms"))
    members = cut_lineage(whole.withColumn("class", F.xxhash64("terms")))
    spark = docs.sparkSession
    size = members.groupBy("class").agg(F.first(F.size("terms")).alias("n")).agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("terms")).head()
    blocks = max(-(-size["classes"] // QUERY_BLOCK), -(-(size["terms"] or 0) // (QUERY_BLOCK * QUERY_TERMS)))
    classes = cut_lineage(members.groupBy("class").agg(F.first("terms").alias("terms")).withColumn("block", F.pmod(F.col("class"), F.lit(max(1, blocks)))))
    # Shards are walked in rounds, a few first and then ``GROWTH`` times as many as before, and each round begins with the
    # k-th best scores of the ones before: so few documents leave a shard for nothing, however many shards there are.
    top = Window.partitionBy("class").orderBy(F.col("score").desc(), "doc_id")
    place = F.pmod(F.xxhash64("shard"), F.lit(1 << 40)) / float(1 << 40)
    rounds = int(math.log(max(1, totals["shards"]), GROWTH))
    whole_near = None
    for block in range(blocks):
        # at most about QUERY_BLOCK
        some = classes.where(F.col("block") == block).select("class", F.col("terms.term").alias("term"), F.col("terms.idf").alias("idf")).toArrow()
        if not some.num_rows:
            continue
        shared, near = spark.sparkContext.broadcast(Asked(some)), None
        for r in range(rounds + 1):
            low, high = (0.0 if r == 0 else float(GROWTH) ** (r - 1 - rounds)), float(GROWTH) ** (r - rounds)
            least = {}
            if near is not None:
                least = {x["class"]: x["least"] for x in near.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") > k).collect()}
            walked = postings.where((place >= low) & (place < high)).select("terms", "lists", "documents")
            found = walked.mapInArrow(_walked(shared, spark.sparkContext.broadcast(least), mean, k + 1), NEAR)
            near = found if near is None else near.unionByName(found)
            near = near.groupBy("class", "doc_id").agg(F.max("score").alias("score"))
            near = cut_lineage(near.withColumn("r", F.row_number().over(top)).where(F.col("r") <= k + 1).drop("r"))
        whole_near = near if whole_near is None else whole_near.unionByName(near)
    if whole_near is None:
        return spark.createDataFrame([], "query_id bigint, rank int, doc_id bigint, score double")
    near = whole_near
    found = members.select("query_id", "class").join(near, "class").where("query_id != doc_id")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
