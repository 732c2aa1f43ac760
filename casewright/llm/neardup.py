"""Near-duplicate documents with DartMinHash signatures.

A document is the weighted set of its five-word shingles, a shingle's weight the number of times it occurs. Darts are
thrown by hash at the plane of each shingle: one axis is weight, the other rank. A dart below the shingle's weight
hits, names one of ``COORDINATES`` coordinates, and the hit of lowest rank in each coordinate is the signature. The
plane is cut into regions of unit weight and, up to a rank of 4, doubling rank, and a document looks only into those up to the rank
where all its coordinates are expected to be hit; if one stays empty, it looks on into twice the rank. So the work
grows with weight plus coordinates, not with their product, and two documents share a coordinate with probability
equal to their weighted Jaccard similarity.

Signatures are banded, ``BANDS`` bands of ``ROWS`` coordinates: a pair of similarity 0.8 shares no band with a
probability below 2e-7. Equal texts are one document in all that follows. Nothing emits all pairs of a bucket:

1. Each bucket's documents are compared with one leader, the smallest; links make components.
2. What is left are buckets with documents outside their largest component. In blocks, inside tasks, each such document
   asks the members of other components, nearest signatures first, until it is linked to their component or nobody is
   left. Only links leave a task. So every candidate pair of different components is checked, and none of equal ones.

A pair whose signatures agree in fewer than ``LEAST_SHARE`` of the coordinates is passed over (for a pair of similarity
0.8 the chance is about 2e-5, and falls fast above); every other one is checked exactly on its shingles. The classes are the connected
components of the checked links.

Defined results: words are runs of letters, digits and underscores in lower case; a text with fewer than five words is
one shingle; null, empty and wordless texts are equal to nothing, so each is its own class; equal ids with different
texts are different documents of one id; a class is named by its smallest id; of several classes with the same
smallest id, the one with the smallest hash of a text of it has the name and the others get negative numbers made of
both; a null id counts as the smallest long;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from casewright.llm.shared import SEEDS as _SEEDS, by_rows, components, cut_lineage, mix as _mix

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 30, 4
COORDINATES = BANDS * ROWS
LEAST_SHARE = 0.65
BLOCK = 512
#: Keys of wanted texts that are sent to every executor at most, some 20 MB; more of them are joined by a shuffle.
BROADCAST_ROWS = 500_000
REMEMBERED = 300_000

_WORD = re.compile(r"\w+")


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(float) * 2.0**-53


def _edge(level: np.ndarray | int) -> np.ndarray:
    """Upper rank of a region: 2^-4, doubling up to 4, from there in steps of 4. Region 0 begins at rank 0."""
    return np.where(np.asarray(level) <= 6, 2.0 ** (np.minimum(level, 6) - 4.0), 4.0 * (np.asarray(level) - 5.0))


def _regions(rank: float) -> int:
    """How many regions reach to ``rank``."""
    return max(1, math.ceil(math.log2(rank)) + 5) if rank <= 4 else math.ceil(rank / 4) + 6


@lru_cache(maxsize=64)
def _poisson(area: float) -> np.ndarray:
    """Distribution function of the number of darts in a region of an area up to 4, as far as doubles tell it from one."""
    p, total, out = math.exp(-area), 0.0, []
    for k in range(1, 41):
        total += p
        out.append(total if total < 1.0 - 2.0**-52 else 2.0)
        p *= area / k
    return np.array(out)


class Shingles:
    """Hashes and weights of a text's word shingles."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.known: dict[str, int] = {}

    def _add(self, word: str) -> int:
        h = self.known[word] = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return h

    def words(self, text: str | None) -> list[str]:
        return _WORD.findall((text or "").lower())

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, add = self.known.get, self._add
        h = np.fromiter([known(w) or add(w) for w in words], dtype=np.uint64, count=len(words))
        n = max(1, len(h) - self.size + 1) if len(h) else 0
        with np.errstate(over="ignore"):
            out = np.zeros(n, dtype=np.uint64)
            for k in range(min(self.size, len(h))):
                out = _mix(out + _SEEDS[0]) ^ h[k : k + n]
            out = _mix(out)
        return np.unique(out, return_counts=True)


def signature(elements: np.ndarray, weights: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The dart of lowest rank in each coordinate, as 32-bit numbers. Weights are positive and may be fractions."""
    strips = np.ceil(weights).astype(np.int64)
    which = np.repeat(np.arange(len(elements)), strips)
    strip = np.arange(len(which)) - np.repeat(np.cumsum(strips) - strips, strips)
    with np.errstate(over="ignore"):
        plane = _mix(elements[which] ^ _mix(strip.astype(np.uint64) * _SEEDS[1] + _SEEDS[2]))
        room = weights[which] - strip  # what of the strip lies below the weight
        reach = (coordinates * math.log(coordinates) + 2 * coordinates) / float(weights.sum())
        ranks, names, done = np.full(coordinates, np.inf), np.zeros(coordinates, dtype=np.uint64), 0
        while True:
            levels = max(done + 1, _regions(reach))
            rank, dart = _darts(plane, room, done, levels)
            place = (_mix(dart + _SEEDS[0]) % np.uint64(coordinates)).astype(np.int64)
            order = np.argsort(-rank, kind="stable")  # later writes win, so the lowest rank of a coordinate stays
            best = np.full(coordinates, -1)
            best[place[order]] = order
            found = np.flatnonzero(best >= 0)
            found = found[rank[best[found]] < ranks[found]]
            ranks[found], names[found] = rank[best[found]], dart[best[found]]
            if np.isfinite(ranks).all():
                return (names >> np.uint64(32)).astype(np.uint32).view(np.int32)
            done, reach = levels, 2 * float(_edge(levels - 1))


def _darts(plane: np.ndarray, room: np.ndarray, first: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks and hashes of the darts that hit in regions ``first`` to ``end``."""
    level = np.arange(first, end)
    high = _edge(level)
    low = np.where(level > 0, _edge(level - 1), 0.0)
    steps = np.vstack([_poisson(float(h - x)) for h, x in zip(high, low)])
    region = _mix(plane[:, None] + (level + 1).astype(np.uint64) * _SEEDS[0])
    chance = _uniform(region)
    row, at = np.nonzero(chance >= steps[:, 0])
    many = (chance[row, at][:, None] >= steps[at]).sum(axis=1)
    row, at = np.repeat(row, many), np.repeat(at, many)
    count = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    dart = _mix(region[row, at] + (count + 1).astype(np.uint64) * _SEEDS[3])
    hit = _uniform(_mix(dart + _SEEDS[1])) < room[row]
    dart, at = dart[hit], at[hit]
    return low[at] + (high - low)[at] * _uniform(_mix(dart + _SEEDS[2])), dart


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both))


def _signed(source: DataFrame) -> DataFrame:
    """Each row's content (a hash of its words in order; null if it has none), its bands' hashes and its sketch.

    The sketch has the lowest byte of each coordinate. That is enough to tell how many coordinates two documents share:
    others agree in a byte by chance once in 256 times.
    """

    def make():
        shingles = Shingles()

        def each(key, body, text):
            words = shingles.words(text)
            if not words:
                return [(key, body, None, None, None)]
            content = hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()
            signed = signature(*_as_floats(shingles(words)))
            return [(key, body, content, band_hashes(signed).tolist(), signed.astype(np.uint8).tobytes())]

        return each

    return cut_lineage(by_rows(source, make, "doc_id bigint, body bigint, content binary, bands array<bigint>, sketch binary"))


def band_hashes(signed: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        rows = signed.view(np.uint32).astype(np.uint64).reshape(BANDS, ROWS)
        out = _mix(np.arange(1, BANDS + 1, dtype=np.uint64) * _SEEDS[3])
        for r in range(ROWS):
            out = _mix(out ^ (rows[:, r] + _SEEDS[r]))
    return out.view(np.int64)


def _as_floats(found: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return found[0], found[1].astype(float)


def _agreeing(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs whose sketches agree in ``LEAST_SHARE`` of the coordinates."""
    one = signed.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    two = signed.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    least = math.ceil(LEAST_SHARE * COORDINATES)

    def make():
        def each(a, b, sa, sb):
            return [(a, b)] if (np.frombuffer(sa, np.uint8) == np.frombuffer(sb, np.uint8)).sum() >= least else []

        return each

    return by_rows(pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb"), make, "a bigint, b bigint")


def _checked(pairs: DataFrame, bodies: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose shingles are similar enough."""
    one = bodies.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    two = bodies.select(F.col("node").alias("b"), F.col("text").alias("tb"))

    def make():
        shingles = Shingles()

        def each(a, b, ta, tb):
            near = similarity(shingles(shingles.words(ta)), shingles(shingles.words(tb))) >= threshold
            return [(a, b)] if near else []

        return each

    return by_rows(pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb"), make, "a bigint, b bigint")


def _unsettled(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets with several components: their component, whether it is not the bucket's largest, and both counts."""
    named = buckets.join(labels, "node", "left").select("bucket", "band", "node", F.coalesce("comp", "node").alias("comp"))
    sizes = named.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("bucket").agg(F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("main")).where("n > main.n")
    mixed = cut_lineage(mixed.select("bucket", F.col("main.comp").alias("main"), F.col("main.n").alias("n_main"), (F.col("n") - F.col("main.n")).alias("n_other")))
    return cut_lineage(named.join(mixed, "bucket").withColumn("asks", F.col("comp") != F.col("main")).drop("main"))


def _groups(rows: pd.DataFrame):
    """The (bucket, block of askers, block of others) groups in a shard, with their sketches and their bands' hashes as matrices."""
    for key, group in rows.sort_values(["bucket", "i", "t", "node"]).groupby(["bucket", "i", "t"], sort=False):
        yield key, group, np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(len(group), COORDINATES), np.stack(group["bands"].to_list())


def _strangers_of(group: pd.DataFrame, sketches: np.ndarray, bands: np.ndarray, i: int) -> np.ndarray:
    """Members of other components whose sketch agrees with ``i``'s, nearest first, if this is the first bucket they share.

    The bands' hashes, which name the buckets, tell which is the first: bytes of a sketch agree by chance too.
    """
    share = (sketches == sketches[i]).sum(axis=1)
    comp, node = group["comp"].to_numpy(), group["node"].to_numpy()
    near = np.flatnonzero((share >= math.ceil(LEAST_SHARE * COORDINATES)) & (comp != comp[i]))
    near = near[(bands[near] == bands[i]).argmax(axis=1) == group["band"].iloc[0]]
    return near[np.lexsort((node[near], -share[near]))]


def _concerned(rows: pd.DataFrame) -> pd.DataFrame:
    """The members of each group that ask or are asked, by sketches alone: only their texts are needed."""
    out = []
    for _, group, sketches, bands in _groups(rows):
        use = np.zeros(len(group), dtype=bool)
        for i in np.flatnonzero(group["asking"].to_numpy()):
            near = _strangers_of(group, sketches, bands, i)
            use[near] = True
            use[i] |= len(near) > 0
        out.append(group[use])
    return pd.concat(out) if out else rows.iloc[:0]


def _linked(threshold: float):
    """In each group, a link from an asker to each other component that has one.

    An asker takes the others by falling agreement and checks them on their shingles, until it is linked to their
    component or nobody is left.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out: set[tuple[int, int]] = set()
        shingles = Shingles()
        for _, group, sketches, bands in _groups(rows):
            node, comp, texts, sets = group["node"].to_numpy(), group["comp"].to_numpy(), group["text"].to_list(), {}

            def at(k: int):
                if k not in sets:
                    sets[k] = shingles(shingles.words(texts[k]))
                return sets[k]

            for i in np.flatnonzero(group["asking"].to_numpy()):
                linked: set[int] = set()
                for j in _strangers_of(group, sketches, bands, i):
                    if comp[j] not in linked and similarity(at(i), at(j)) >= threshold:
                        linked.add(comp[j])
                        out.add((int(min(node[i], node[j])), int(max(node[i], node[j]))))
        return pd.DataFrame({n: np.array([x[k] for x in out], dtype="i8") for k, n in enumerate(("a", "b"))})

    return run


MEMBERS = "bucket bigint, band int, node bigint, comp bigint, i bigint, t bigint, asking boolean, sketch binary, bands array<bigint>"


def _asked(mixed: DataFrame, signed: DataFrame, bodies: DataFrame, threshold: float) -> DataFrame:
    """Links between components of the unsettled buckets, which are dealt into blocks of about ``BLOCK`` members."""
    zero = F.lit(0).cast("bigint")
    askers = F.ceil(F.col("n_other") / BLOCK)
    others = F.ceil(F.col("n_main") / BLOCK)
    own = F.when(F.col("asks"), F.pmod(F.xxhash64("node"), askers)).otherwise(F.pmod(F.xxhash64("node"), others))
    m = mixed.withColumn("askers", askers).withColumn("others", others).withColumn("own", own)
    base = ["bucket", "band", "node", "comp"]
    ask = m.where("asks").select(*base, F.col("own").alias("i"), F.explode(F.sequence(zero, F.col("askers") + F.col("others") - 1)).alias("t"), F.lit(True).alias("asking"))
    target = F.when(F.col("asks"), F.col("others") + F.col("own")).otherwise(F.col("own"))
    told = m.select(*base, F.explode(F.sequence(zero, F.col("askers") - 1)).alias("i"), target.alias("t"), F.lit(False).alias("asking"), "asks", "own").where("NOT (asks AND i = own)").drop("asks", "own")
    rows = ask.unionByName(told).join(signed.select("node", "sketch", "bands"), "node")
    shard = F.pmod(F.xxhash64("bucket", "i", "t"), F.lit(max(1, -(-mixed.count() // 1024))))
    concerned = cut_lineage(rows.withColumn("shard", shard).groupBy("shard").applyInPandas(lambda g: _concerned(g.drop(columns="shard"))[[c.split()[0] for c in MEMBERS.split(", ")]], MEMBERS))
    shard = F.pmod(F.xxhash64("bucket", "i", "t"), F.lit(max(1, -(-concerned.count() // 512))))
    return concerned.join(bodies, "node").withColumn("shard", shard).groupBy("shard").applyInPandas(_linked(threshold), "a bigint, b bigint")


def _classed(docs: DataFrame, doc_id: str, text: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, body, first)`` for every row of ``docs``, and the distinct ``(doc_id, body)`` of all firsts.

    ``body`` is xxhash64 of the text, which tells rows of one id apart. ``first`` is the smallest (doc_id, body) of the
    row's class, which no other class has.
    """
    source = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(2**63))).alias("doc_id"), F.xxhash64(F.col(text)).alias("body"), F.col(text).alias("text"))
    rows = _signed(source)
    # one node for each content, with the smallest id that has it
    contents = rows.where("content is not null").groupBy("content").agg(F.min(F.struct("doc_id", "body")).alias("first"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    signed = cut_lineage(contents.select(F.xxhash64("content").alias("node"), F.col("first.doc_id").alias("doc_id"), F.col("first.body").alias("body"), "bands", "sketch"))
    flat = signed.select("node", F.posexplode("bands").alias("band", "bucket"))
    full = cut_lineage(flat.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("leader")).where("n > 1").drop("n"))
    buckets = cut_lineage(flat.join(full, "bucket"))
    pairs = cut_lineage(_agreeing(buckets.where("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), signed))
    buckets = buckets.select("bucket", "band", "node")
    # all texts that any later step can ask for, fetched once
    wanted = cut_lineage(buckets.select("node").distinct().join(signed.select("node", "doc_id", "body"), "node"))
    near = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    bodies = source.join(near, ["doc_id", "body"]).groupBy("doc_id", "body", "node").agg(F.first("text").alias("text"))
    bodies = cut_lineage(bodies.select("node", "text"))
    links = cut_lineage(_checked(pairs, bodies, threshold))
    labels = components(links)
    mixed = _unsettled(buckets, labels)
    if not mixed.isEmpty():
        links = cut_lineage(links.unionByName(_asked(mixed, signed, bodies, threshold)))
        labels = components(links)
    whole = signed.select("node", F.struct("doc_id", "body").alias("own")).join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = cut_lineage(whole.groupBy("comp").agg(F.min("own").alias("first")))
    by_node = cut_lineage(whole.join(named, "comp").select("node", "first"))
    out = rows.select("doc_id", "body", F.xxhash64("content").alias("node"), F.col("content").isNull().alias("alone")).join(by_node, "node", "left")
    out = out.select("doc_id", "body", F.when(F.col("alone"), F.struct("doc_id", "body")).otherwise(F.col("first")).alias("first"))
    return out, named.select("first.*").unionByName(rows.where("content is null").select("doc_id", "body").distinct())


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """``(doc_id, body, class_id)`` for every row of ``docs``, with ``body`` as xxhash64 of the text."""
    out, firsts = _classed(docs, doc_id, text, threshold)
    name = F.col("first.doc_id")
    disputed = cut_lineage(firsts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("body").alias("holder")).where("n > 1").select(F.col("doc_id").alias("name"), "holder"))
    count = disputed.count()
    if count:
        other = -F.pmod(F.xxhash64("first"), F.lit(1 << 62)) - 1
        out = out.withColumn("name", name).join(F.broadcast(disputed) if count <= BROADCAST_ROWS else disputed, "name", "left")
        name = F.when(F.col("holder") != F.col("first.body"), other).otherwise(F.col("name"))
    return out.select("doc_id", "body", name.alias("class_id"))


def kept(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class, the smallest by id and then by hash of the text; of rows equal in id and text, the one of smallest hash of all columns."""
    _, firsts = _classed(docs, doc_id, text, threshold)
    chosen = cut_lineage(firsts.withColumnRenamed("doc_id", "id"))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(2**63))).alias("id"), F.xxhash64(F.col(text)).alias("body"))
    # maps have no hash; they are the only columns that may differ between equal choices
    told = [F.col("row")[f.name] for f in docs.schema if "map<" not in f.dataType.simpleString()]
    return keyed.join(chosen, ["id", "body"]).groupBy("id", "body").agg(F.min_by("row", F.xxhash64(*told)).alias("row")).select("row.*")
