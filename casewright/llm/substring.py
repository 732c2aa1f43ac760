"""Substring dedup with suffix automata of reference shards.

Every word of a document that lies in a window of ``window`` consecutive words whose word sequence also starts
anywhere else, in any document, is removed. Windows are judged on the input.

Sending every shard's automaton past every document would cost shards x corpus, so windows are routed to the one
shard that can hold their like. A window's smallest ``gram``-word hash names its shard: equal windows have equal
grams. A maximal run of windows with the same smallest gram is one stretch, so each window is in exactly one stretch,
and a stretch is all that a document streams past a shard.

1. Documents give stretches: shard key, a content hash, and where it starts. They are written once.
2. Stretches of a key are counted by content. A key that occurs once has no repeated window and ends here, which is
   most of an unrepetitive corpus. Where all stretches of a key are equal, every window in them is repeated. One
   carrier stands for each content, so thousands of copies are one row.
3. Keys with different contents go on with their words. The contents of a shard, one carrier each, are the reference:
   a suffix automaton over them, with the number of occurrences for each state. All contents stream through it: where
   the matching statistic reaches ``window`` words, the state of the last ``window`` words tells how often they occur.
4. A key with more than ``TOGETHER`` contents is dealt over several automata. What is single within one of them may
   still occur in another one, so those windows, and one of each repeated window, are counted over all parts by hash.
5. Repeated windows go back to their documents as spans of words; each document drops the union of its spans.

Defined results: a null text has no words; words are runs of anything but space and U+0009 to U+000D, unchanged;
documents shorter than the window lose nothing; equal rows are separate places, so each of them loses its repeated
windows; rows with a null id, or with ids that repeat, are rows like any other; rows are told apart by id and a 64-bit
hash of the text, keys and contents by 64-bit hashes (of n texts two clash with odds of about n**2 / 2**65); an empty table gives an empty result; other columns pass through untouched, in a struct.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from casewright.llm.shared import by_rows, cut_lineage

WINDOW = 35
GRAM = 8
#: Contents of one key that share an automaton, and contents in one shard, which holds the automata of several keys.
TOGETHER = 128
SHARD = 256
#: Windows of a stretch; a longer run of windows with one smallest gram, as in a text of one repeated word, is several.
MOST_WINDOWS = 1024
#: Words whose hash a task remembers.
REMEMBERED = 300_000
#: Stands for a null id.
_NO_ID = -(1 << 63)

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1)

STRETCHES = "doc bigint, body bigint, key array<bigint>, content array<bigint>, begin array<int>, windows array<int>, again array<boolean>"


def words_of(text: str | None) -> list[bytes]:
    """Runs of bytes other than the ASCII white space that ``bytes.split`` knows: space and U+0009 to U+000D."""
    return (text or "").encode("utf-8", "surrogatepass").split()


class Hasher:
    """A 64-bit hash for each word, remembered for frequent ones."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def _add(self, word: bytes) -> int:
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self.known[word] = h
        return h

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, add = self.known.get, self._add
        return np.fromiter([known(w) or add(w) for w in words], dtype=np.uint64, count=len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(4096, 2 * n)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        have = _POWERS[base] = (both[0], both[1])
    return have[0][:n], have[1][:n]


def _ranges(hashes: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums from which the hash of any range follows in one step."""
    up, _ = _powers(base, len(hashes))
    return np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])


def _range_hash(sums: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _powers(base, len(sums))
    return (sums[end] - sums[start]) * down[start]


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each ``width`` consecutive values."""
    got, have = values, 1
    while have < width:
        step = min(have, width - have)
        got = np.minimum(got[: len(got) - step], got[step:])
        have += step
    return got


def stretches_of(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Key, content hash, first window, number of windows of each stretch, and whether it may repeat a window itself.

    Two equal windows of one stretch have their key's gram at two places less than a window apart, so a stretch where no
    gram comes back that soon repeats nothing by itself.
    """
    n = len(hashes)
    if n < window:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, z, z
    with np.errstate(over="ignore"):
        sums = _ranges(hashes, _BASE[0])
        at = np.arange(n - gram + 1)
        grams = _mix(_range_hash(sums, _BASE[0], at, at + gram))
        least = _smallest(grams, window - gram + 1)
        begin = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        if np.diff(np.append(begin, len(least))).max() > MOST_WINDOWS:
            begin = np.concatenate([np.arange(a, b, MOST_WINDOWS) for a, b in zip(begin, [*begin[1:], len(least)])])
        count = np.diff(np.append(begin, len(least)))
        end = begin + count + window - 1
        other = _ranges(_mix(hashes), _BASE[1])
        content = _mix(_range_hash(sums, _BASE[0], begin, end)) ^ _mix(_range_hash(other, _BASE[1], begin, end) + count.astype(np.uint64))
    order = np.argsort(grams, kind="stable")
    back = np.zeros(len(grams) + 1, dtype=np.int64)
    near = (np.diff(order) < window) & (grams[order[1:]] == grams[order[:-1]])
    back[1 + order[1:][near]] = 1
    back = np.cumsum(back)
    return least[begin].view(np.int64), content.view(np.int64), begin, count, back[end - gram + 1] > back[begin]


class Automaton:
    """Suffix automaton of several word sequences, with the number of occurrences for each state."""

    def __init__(self):
        self.length, self.link, self.next, self.seen = [0], [-1], [{}], [0]

    def add(self, words: list, times: int) -> None:
        """Add a sequence that occurs ``times`` times."""
        length, link, step, seen = self.length, self.link, self.next, self.seen
        last = 0
        for w in words:
            q = step[last].get(w)
            if q is not None and length[q] == length[last] + 1:
                last = q
                seen[q] += times
                continue
            if q is not None:
                clone = self._clone(last, w, q)
                seen[clone] += times
                last = clone
                continue
            state = len(length)
            length.append(length[last] + 1)
            step.append({})
            seen.append(times)
            link.append(0)
            p = last
            while p != -1 and w not in step[p]:
                step[p][w] = state
                p = link[p]
            if p != -1:
                q = step[p][w]
                link[state] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
            last = state

    def _clone(self, p: int, w, q: int) -> int:
        length, link, step = self.length, self.link, self.next
        clone = len(length)
        length.append(length[p] + 1)
        step.append(step[q].copy())
        self.seen.append(0)
        link.append(link[q])
        link[q] = clone
        while p != -1 and step[p].get(w) == q:
            step[p][w] = clone
            p = link[p]
        return clone

    def count(self) -> None:
        """Pass occurrences up the suffix links, longest states first."""
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.seen[self.link[s]] += self.seen[s]

    def statistics(self, words: list, window: int) -> Iterator[int]:
        """For each window of ``words``, how often it occurs in what was added."""
        length, link, step, seen = self.length, self.link, self.next, self.seen
        state, matched = 0, 0
        for i, w in enumerate(words):
            while state and w not in step[state]:
                state = link[state]
                matched = length[state]
            if w in step[state]:
                state = step[state][w]
                matched += 1
            while link[state] >= 0 and length[link[state]] >= window:
                state = link[state]
                matched = length[state]
            if i >= window - 1:
                yield seen[state] if matched >= window else 0


def _runs(flags: list[bool]) -> tuple[list[int], list[int]]:
    """Starts and lengths of the runs of true flags."""
    edge = np.diff(np.concatenate([[0], np.asarray(flags, dtype=np.int8), [0]]))
    start = np.flatnonzero(edge == 1)
    return start.tolist(), (np.flatnonzero(edge == -1) - start).tolist()


def _window_hashes(words: list[bytes], at: list[int], window: int) -> list[bytes]:
    return [hashlib.blake2b(b" ".join(words[i : i + window]), digest_size=16).digest() for i in at]


def _judge(window: int):
    """One group of keys: an automaton for each (key, part), then every content's repeated windows."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        rows = sorted(zip(group["key"].tolist(), group["part"].tolist(), group["content"].tolist(), group["times"].tolist(), group["parts"].tolist(), group["words"]))
        for (key, _), members in groupby(rows, key=lambda r: r[:2]):
            members = list(members)
            several = members[0][4] > 1
            texts = [words_of(m[5]) for m in members]
            shard = Automaton()
            for words, m in zip(texts, members):
                shard.add(words, m[3])
            shard.count()
            told: set[bytes] = set()
            for content, words in zip((m[2] for m in members), texts):
                often = list(shard.statistics(words, window))
                starts, counts = _runs([n > 1 for n in often])
                out.extend((key, content, s, n, None, None) for s, n in zip(starts, counts))
                if several:
                    for i, h in enumerate(_window_hashes(words, range(len(often)), window)):
                        if often[i] == 1:
                            out.append((key, content, i, 1, h, 1))
                        elif h not in told:
                            told.add(h)
                            out.append((key, content, i, 1, h, 2))
        return pd.DataFrame(out, columns=["key", "content", "start", "n", "hash", "weight"])

    return run


def repeated_windows(docs: DataFrame, doc: str, text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Spans of words to remove: ``(doc, body, spans array<struct<start,end>>)``, one row for each distinct document with any.

    ``doc`` names a long column. It need not be unique: a place is known by it and a hash of the text, and rows equal in
    both have the same windows.
    """
    body = F.xxhash64(F.col(text))
    source = docs.select(_place(doc), body.alias("body"), F.col(text).alias("text"))

    def cut():
        hashed = Hasher()

        def each(key, body_, text_):
            got = stretches_of(hashed(words_of(text_)), window, gram)
            return [(key, body_, *(x.tolist() for x in got))] if len(got[0]) else []

        return each

    cuts = cut_lineage(by_rows(source, cut, STRETCHES))
    flat = cuts.select("doc", "body", F.explode(F.arrays_zip("key", "content", "begin", "windows", "again")).alias("s")).select("doc", "body", "s.*")
    place = F.struct("doc", "body", "begin", "windows")
    keys = flat.groupBy("key").agg(F.count(F.lit(1)).alias("times"), F.min("content").alias("low"), F.max("content").alias("high"), F.max("again").alias("again"))
    keys = cut_lineage(keys.where("times > 1 OR again").select("key", (F.col("again") | (F.col("low") != F.col("high"))).alias("mixed")))
    # places of repeated keys; the count goes on by content
    places = cut_lineage(flat.join(keys, "key"))
    classes = places.where("mixed").groupBy("key", "content").agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("p"))
    classes = cut_lineage(classes.select("key", "content", "times", "p.doc", "p.body", "p.begin", "p.windows"))
    parts = cut_lineage(classes.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / TOGETHER).alias("parts")).where("parts > 1"))
    wanted = classes.join(parts, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("bigint"))).withColumn("part", F.pmod(F.col("content"), F.col("parts")))
    wanted = wanted.groupBy("doc", "body").agg(F.collect_list(F.struct("key", "content", "times", "begin", "windows", "parts", "part")).alias("wanted"))
    carried = source.join(cut_lineage(wanted), ["doc", "body"]).groupBy("doc", "body").agg(F.first("text").alias("text"), F.first("wanted").alias("wanted"))

    def fetch():
        def each(text_, wanted_):
            words = words_of(text_)
            for w in wanted_:
                end = w["begin"] + w["windows"] + window - 1
                yield w["key"], w["content"], w["times"], w["parts"], w["part"], b" ".join(words[w["begin"] : end]).decode("utf-8", "surrogatepass")

        return each

    reference = by_rows(carried.select("text", "wanted"), fetch, "key bigint, content bigint, times bigint, parts bigint, part bigint, words string")
    shards = max(1, -(-classes.count() // SHARD))
    judged = cut_lineage(reference.withColumn("shard", F.pmod(F.xxhash64("key", "part"), F.lit(shards))).groupBy("shard").applyInPandas(_judge(window), "key bigint, content bigint, start bigint, n bigint, hash binary, weight bigint"))
    single = judged.where("hash is not null")
    often = single.groupBy("hash").agg(F.sum("weight").alias("all")).where("all > 1")
    across = single.where("weight = 1").join(often, "hash").select("key", "content", "start", "n")
    hits = judged.where("hash is null").select("key", "content", "start", "n").unionByName(across)
    hits = cut_lineage(hits.groupBy("key", "content").agg(F.collect_list(F.struct("start", "n")).alias("hits")))
    mixed = places.where("mixed").join(hits, ["key", "content"]).select("doc", "body", F.explode("hits").alias("h"), "begin")
    mixed = mixed.select("doc", "body", (F.col("begin") + F.col("h.start")).alias("start"), (F.col("begin") + F.col("h.start") + F.col("h.n") + window - 1).alias("end"))
    whole = places.where("not mixed").select("doc", "body", F.col("begin").cast("bigint").alias("start"), (F.col("begin") + F.col("windows") + window - 1).cast("bigint").alias("end"))
    spans = whole.unionByName(mixed).groupBy("doc", "body").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    return cut_lineage(spans)


def _place(doc: str) -> Column:
    """A row's id, never null: with the hash of its text it names a place, and rows equal in both have equal windows."""
    return F.coalesce(F.col(doc).cast("bigint"), F.lit(_NO_ID)).alias("doc")


def clean(docs: DataFrame, doc: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(row, words, removed, kept)``: each row of ``docs`` as a struct, its number of words, how many were removed, and the kept words joined by one space."""
    spans = repeated_windows(docs, doc, text, window, gram)
    rows = docs.select(F.struct(*docs.columns).alias("row"), _place(doc), F.xxhash64(F.col(text)).alias("body"))
    joined = rows.join(spans, ["doc", "body"], "left")
    # native, so the other columns need not pass through Python
    inner = F.btrim(F.coalesce(F.col("row")[text], F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+", -1))
    whole = joined.select("row", "spans", words.alias("all"))
    whole = whole.select("row", F.size("all").cast("bigint").alias("words"), _kept(F.col("all"), F.col("spans")).alias("left"))
    return whole.select("row", "words", (F.col("words") - F.size("left")).alias("removed"), F.array_join("left", " ").alias("kept"))


def _kept(words: Column, spans: Column) -> Column:
    """``words`` outside the spans: the slices between merged spans."""

    def step(acc: Column, s: Column) -> Column:
        gap = F.slice(words, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] > acc["at"], F.concat(acc["out"], gap)).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.slice(words, (acc["at"] + 1).cast("int"), F.greatest(F.size(words) - acc["at"], F.lit(0)).cast("int"))))
    return F.when(spans.isNull(), words).otherwise(done)
