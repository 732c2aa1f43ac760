"""Source divergence: single-pass blocks and the heap merge against plain counts, the whole result against a brute-force version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from casewright.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, least):
    """{(lang, term): {source: n}} of kept terms, and the groups."""
    n, docs, groups = defaultdict(Counter), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = TERM.findall((text or "").translate(LOWER))
        for t in found:
            n[lang, t][source] += 1
        docs.update({(lang, t) for t in found})
    return {k: v for k, v in n.items() if docs[k] >= least}, groups


def brute(rows, least=10, top=10):
    kept, groups = counted(rows, least)
    out = []
    share = lambda c, n, v: 1 + 1_000_000_000 * (c + 2) // (n + 2 * v)
    far = lambda p, q: (p - q) * (p - q) // (p + q)
    for lang, source in groups:
        terms = [t for l, t in kept if l == lang]
        size = lambda s: sum(kept[lang, t][s] for t in terms)
        v, whole = len(terms), sum(sum(kept[lang, t].values()) for t in terms)
        p = {t: share(kept[lang, t][source], size(source), v) for t in terms}
        pairs = []
        for l, other in groups:
            if l == lang and other != source:
                n = size(other)
                pairs.append((-sum(far(p[t], share(kept[lang, t][other], n, v)) for t in terms), other.encode(), other))
        out += [(lang, source, "pair", item, -value, k + 1) for k, (value, _, item) in enumerate(sorted(pairs))]
        best = []
        for t in terms:
            q = share(sum(kept[lang, t].values()), whole, v)
            if kept[lang, t][source] > 0 and p[t] > q:
                best.append((-far(p[t], q), t.encode(), t))
        out += [(lang, source, "term", item, -value, k + 1) for k, (value, _, item) in enumerate(sorted(best)[:top])]
    return sorted(out)


def some_rows(n=400, seed=2):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "Größe", "ÉTÉ", "été", "x1y", "don't", "日本", "İi", "ſ", "K", "\x85a", "zz_zz", *[f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(9)]]
    rows = []
    for i in range(n):
        # the first source holds a third of all rows
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "ä", "B", None, "", "c" * 30])
        rows.append((" ".join(rng.choices(words, k=rng.randrange(25))), rng.choice(["en", "en", "de", None]), source))
    return rows + [(None, "en", "only nulls"), ("", "xx", "one"), ("\x00\x1f 12", "xx", "two"), ("same words", "yy", "one")] * 3


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "text string, lang string, source string, term string, shard int, p string")


def test_against_brute_force(spark):
    rows = some_rows()
    got = divergence.audit(frame(spark, rows).repartition(5))
    assert sorted(map(tuple, got.select("lang", "source", "part", "item", "value", "rank").collect())) == brute(rows)


def test_ties_repeats_and_empty_table(spark):
    rows = [("b a c d", "en", s) for s in ("s1", "s2", "s3") for _ in range(10)] + [("q q", "en", "s4")] * 10
    got = divergence.audit(frame(spark, rows))
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert divergence.audit(frame(spark, rows).where("false")).count() == 0


def test_counts_beyond_64_bit_products(spark):
    n, size = 9 * 10**14, 10**15
    row = spark.range(1).select(divergence._share(F.lit(n), F.lit(size), F.lit(7)).alias("a"), divergence._share(F.lit(5), F.lit(size), F.lit(7)).alias("b")).first()
    assert row["a"] == 1 + 10**9 * (n + 2) // (size + 14) and row["b"] == 1


def test_blocks_and_heap_merge(monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK", 7)
    monkeypatch.setattr(divergence, "HELD", 30)
    monkeypatch.setattr(divergence, "SLICE_BYTES", 20)
    rows, shards, least = [(t or "", l or "", s or "") for t, l, s in some_rows(300, 4)], 3, 6
    chunks = []
    block = divergence.Block(shards)
    for k, (text, lang, source) in enumerate(rows):
        block.add(text.encode(), lang, source)
        if k % 11 == 10:
            chunks += [c for b in block.runs() for c in b.to_pylist()]
    chunks += [c for b in block.runs() for c in b.to_pylist()] if block.groups else []
    assert all(c["terms"] == sorted(c["terms"]) and len(c["terms"]) <= 7 for c in chunks)
    got, totals, firsts = defaultdict(dict), {}, Counter()
    for shard in range(shards):
        merging, found, held = divergence.Merge(least), [], 0
        for c in sorted((c for c in chunks if c["shard"] == shard), key=lambda c: (c["lang"], c["first"])):
            found += list(merging.add(c["lang"], c["terms"], c["sources"], np.array(c["counts"]), np.array(c["docs"])))
            held = max(held, merging.size)
        found += list(merging.finish())
        assert held < sum(len(c["terms"]) for c in chunks if c["shard"] == shard) / 3
        for f in found:
            if f:
                for lang, source, term, n, total, first in zip(*(x.to_pylist() for x in f)):
                    assert source not in got[lang, term]
                    got[lang, term][source] = n
                    totals[lang, term] = total
                    firsts[lang, term] += first
    kept, groups = counted(rows, least)
    marks = {k: v for k, v in got.items() if k[1] == ""}
    assert {(l, s) for (l, _), v in marks.items() for s in v} == groups
    assert {k: v for k, v in got.items() if k[1]} == {k: dict(v) for k, v in kept.items()}
    assert all(firsts[k] == 1 and totals[k] == sum(v.values()) for k, v in got.items())


def test_one_very_long_text(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_BYTES", 1000)
    text = " ".join(["Ab", "cd", "é" * 3] * 3000) + " " + "z" * 5000
    block = divergence.Block(1)
    block.add(text.encode(), "en", "s")
    got = {t: (n, d) for b in block.runs() for c in b.to_pylist() for t, n, d in zip(c["terms"], c["counts"], c["docs"]) if t}
    assert got == {b"ab": (3000, 1), b"cd": (3000, 1), "ééé".encode(): (3000, 1), b"z" * 5000: (1, 1)}
