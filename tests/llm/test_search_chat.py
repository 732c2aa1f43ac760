"""Neighbours, BM25 and chat formatting against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casewright.llm import ann, chat, search


def _vectors(spark, n=1500, size=16, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, size)).astype("f4")
    x[100:400] = x[100]  # one very common vector
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(5000, None, 0), (5020, [0.0] * size, 0), (5040, [math.nan] * size, 0), (5060, [1.0, None] * (size // 2), 0), (5080, [1.0], 0), (5100, [], 0), (5120, [math.inf] * size, 0), (None, [1.0] * size, 0)]
    return x.astype("f8"), spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>, cell int")


def test_neighbours_recall_and_order(spark, monkeypatch):
    monkeypatch.setattr(ann, "UNIT", 200)
    monkeypatch.setattr(ann, "BLOCK", 16)
    x, df = _vectors(spark)
    got = defaultdict(list)
    for r in ann.search(df, 20, 20).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 1500, 20))
    hit = 0
    for q, rows in got.items():
        s = (x * x[q]).sum(axis=1)
        want = [i for i in np.lexsort((np.arange(len(x)), -s)).tolist() if i != q][:20]
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21)) and q not in [r[1] for r in rows]
        assert all(r[2] == pytest.approx(s[r[1]], abs=1e-12) for r in rows)
        assert [(-r[2], r[1]) for r in rows] == sorted((-r[2], r[1]) for r in rows)
        hit += len({r[1] for r in rows} & set(want))
    assert hit / (20 * len(got)) >= 0.9
    every_cell = {(r.query_id, r["rank"]): r.vec_id for r in ann.search(df, 20, 20, share=1.0).collect()}
    for q in got:
        s = (x * x[q]).sum(axis=1)
        want = [i for i in np.lexsort((np.arange(len(x)), -s)).tolist() if i != q][:20]
        assert [every_cell[q, k + 1] for k in range(20)] == want


def test_few_or_no_vectors(spark):
    _, df = _vectors(spark)
    assert ann.search(df.where("false"), 20, 20).count() == 0
    assert ann.search(df.where("vec_id = 0"), 20, 20).count() == 0
    few = ann.search(df.where("vec_id < 3"), 20, 20).collect()
    assert [r["rank"] for r in sorted(few, key=lambda r: r["rank"])] == [1, 2]


def test_rows_of_one_id_are_rows_like_any_other(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(60, 8))
    ids = [20 if i < 3 else i for i in range(60)]
    df = spark.createDataFrame([(ids[i], x[i].tolist(), 0) for i in range(60)], "vec_id bigint, embedding array<double>, label int")
    got = ann.search(df, 20, 5, share=1.0).where("query_id = 20").collect()
    want = []
    for q in [i for i in range(60) if ids[i] == 20]:
        s = (x * x[q]).sum(axis=1)
        near = sorted((-s[i], ids[i]) for i in range(60) if i != q)[:5]
        want += [(20, k + 1, v) for k, (_, v) in enumerate(near)]
    assert len(want) == 20 and sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == sorted(want)


def _bm25(texts, every, k):
    words = [re.findall(r"[^\W_]+", (t or "").lower()) for t in texts]
    tfs = [Counter(w) for w in words]
    df = Counter(t for c in tfs for t in c)
    n, mean = len(texts), sum(map(len, words)) / len(texts)
    idf = {t: math.log(1 + (n - d + 0.5) / (d + 0.5)) for t, d in df.items()}
    out = {}
    for q in range(0, n, every):
        terms = sorted(tfs[q], key=lambda t: (-round(tfs[q][t] * idf[t], 9), t))[: search.TERMS]
        scored = []
        for i in range(n):
            if i != q and any(t in tfs[i] for t in terms):
                scored.append((-round(sum(search.weight(idf[t], tfs[i][t], len(words[i]), mean) for t in terms if t in tfs[i]), 6), i))
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def test_search_equals_a_full_scan(make_docs, odd_texts, monkeypatch, spark):
    rng = random.Random(3)
    monkeypatch.setattr(search, "BLOCK", 3)
    monkeypatch.setattr(search, "SHARD_ROWS", 70)
    vocabulary = [f"t{i}" for i in range(120)]
    texts = odd_texts + [" ".join(rng.choices(vocabulary, weights=[1 / (i + 1) for i in range(120)], k=rng.randrange(1, 80))) for _ in range(400)] + ["t1 t5 t9"] * 40
    got = defaultdict(list)
    for r in search.search(make_docs(texts).coalesce(2), 10, 7, terms=search.TERMS).collect():
        got[r.query_id].append((r["rank"], r.doc_id, r.score))
    want = _bm25(texts, 10, 7)
    for q, rows in want.items():
        assert [g[1] for g in sorted(got[q])] == [r[0] for r in rows]
        assert [g[2] for g in sorted(got[q])] == pytest.approx([r[1] for r in rows], abs=2e-6)


def test_whole_rows_search_with_every_term(make_docs, monkeypatch):
    rng = random.Random(11)
    vocabulary = [f"t{i}" for i in range(300)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 200))) for _ in range(120)]
    assert len(set(texts[0].split())) > search.TERMS
    got = defaultdict(list)
    for block in (search.QUERY_BLOCK, 2):  # long queries in several blocks give the same
        got.clear()
        with monkeypatch.context() as m:
            m.setattr(search, "QUERY_BLOCK", block)
            for r in search.search(make_docs(texts).coalesce(2), 10, 7).collect():
                got[r.query_id].append((r["rank"], r.doc_id, r.score))
        with monkeypatch.context() as m:
            m.setattr(search, "TERMS", 10**6)
            want = _bm25(texts, 10, 7)
        for q, rows in want.items():
            assert [g[1] for g in sorted(got[q])] == [r[0] for r in rows]
            assert [g[2] for g in sorted(got[q])] == pytest.approx([r[1] for r in rows], abs=2e-6)


def test_a_shard_is_one_row_and_is_walked_without_an_exchange(make_docs, monkeypatch):
    monkeypatch.setattr(search, "SHARD_ROWS", 3)
    found = search.index(make_docs(["b a b", "a", None, "c", "c c a"]).coalesce(1)).orderBy("shard").collect()
    assert [[d.id for d in r.documents] for r in found] == [[0, 1, 2], [3, 4]] and [[d.words for d in r.documents] for r in found] == [[3, 1, 0], [1, 3]]
    named = [search._terms_in(pa.scalar(bytes(r.terms), pa.binary())).to_pydict() for r in found]
    assert named == [{"term": ["b", "a"], "n": [1, 2]}, {"term": ["c", "a"], "n": [2, 1]}]
    rows = [np.frombuffer(r.lists, "<u2").tolist() for r in found]  # rows of two bytes, then frequencies of four, list after list
    assert rows == [[0, 2, 0, 0, 1, 1, 0, 1, 0], [0, 1, 1, 0, 2, 0, 1, 1, 0]]


def test_search_of_nothing_and_of_repeated_ids(make_docs):
    docs = make_docs(["alpha beta", "alpha", "beta beta", None, ""])
    assert search.search(docs.where("false"), 1, 5).count() == 0
    once = search.search(docs, 1, 5).collect()
    assert {(r.query_id, r.doc_id) for r in once} == {(0, 1), (0, 2), (1, 0), (2, 0)}
    twice = search.search(docs.unionByName(docs), 1, 5).collect()
    assert {(r.query_id, r.doc_id) for r in twice} == {(r.query_id, r.doc_id) for r in once} and len(twice) == len(once)


def test_walk_skips_blocks_and_loses_nothing():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randrange(1, 400)
        lengths = [rng.randrange(1, 90) for _ in range(n)]
        lists, scores = [], defaultdict(list)
        for _ in range(rng.randrange(1, 6)):
            rows = sorted(rng.sample(range(n), rng.randrange(1, n + 1)))
            tfs, idf = [rng.choice((1, 1, 1, 2, 9)) for _ in rows], rng.random() * 5
            spans = [range(i, min(i + search.BLOCK, len(rows))) for i in range(0, len(rows), search.BLOCK)]
            bounds = [search.weight(idf, max(tfs[i] for i in s), min(lengths[rows[i]] for i in s), 40.0) for s in spans]
            lists.append(search.List(idf, rows, tfs, bounds))
            for r, f in zip(rows, tfs):
                scores[r].append(search.weight(idf, f, lengths[r], 40.0))
        want = sorted(((round(sum(v), 6), r) for r, v in scores.items()), key=lambda x: (-x[0], x[1]))[:5]
        got = search.walk(lists, list(range(n)), lengths, 40.0, 5)
        assert [g[1] for g in got] == [w[1] for w in want] and [g[0] for g in got] == pytest.approx([w[0] for w in want], abs=2e-6)


@pytest.mark.parametrize("together, cells", [(512, 4_000_000), (2, 4_000_000), (3, 100), (5, 0)])
def test_walk_of_many_queries_is_the_walk_of_each(monkeypatch, together, cells):
    for name, value in {"BLOCK": 8, "TOGETHER": together, "CELLS": cells, "GATHERED": 50}.items():
        monkeypatch.setattr(search, name, value)
    rng = random.Random(9)
    for case in range(40):
        n, k = rng.randrange(1, 150), rng.randrange(1, 9)
        ids = [rng.choice([i, i, i, 3, None]) if case % 2 else i for i in range(n)]
        lists = [sorted(rng.sample(range(n), rng.randrange(1, n + 1) if rng.random() < 0.3 else min(n, 2))) for _ in range(12)]
        weights = [[rng.choice((0.5, 1.0, 1e-9, rng.random() * 4)) for _ in rows] for rows in lists]
        queries = [sorted(rng.sample(range(12), rng.randrange(0, 13))) for _ in range(11)]
        least = [rng.choice((0.0, 0.0, 1.0, 3.0)) for _ in queries]
        begin = np.cumsum([0, *map(len, lists)])
        got = {
            q: list(zip(i.tolist(), s.tolist()))
            for q, i, s in search.walk_blocks(
                np.array(sum(lists, [])), np.array(sum(weights, [])), begin, ids, np.array(sum(queries, []), dtype=int), np.cumsum([len(q) for q in queries]), np.array(least), k
            )
        }
        for q, terms in enumerate(queries):
            scores = defaultdict(float)
            for t in terms:
                for row, w in zip(lists[t], weights[t]):
                    scores[row] += w
            best = {}
            for row, s in scores.items():
                if ids[row] is not None:
                    best[ids[row]] = max(best.get(ids[row], 0.0), round(s, 6))
            want = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
            mine = [w for w in got.get(q, []) if w[1] >= least[q]]
            want = [w for w in want if w[1] >= least[q]]
            assert [m[0] for m in mine] == [w[0] for w in want] and [m[1] for m in mine] == pytest.approx([w[1] for w in want], abs=1e-9)


def test_blocks_below_the_best_are_not_scored(monkeypatch):
    """Only blocks whose bound reaches a query's k-th best are scored; ``weights`` elsewhere are read for the bounds alone."""
    monkeypatch.setattr(search, "BLOCK", 4)
    rows, weights, begin = np.arange(400), np.where(np.arange(400) < 4, 9.0, 1.0), np.array([0, 400])
    scored, rounded = [], np.round
    monkeypatch.setattr(search.np, "round", lambda x, d: scored.append(x.size) or rounded(x, d))
    out = list(search.walk_blocks(rows, weights, begin, list(range(400)), np.array([0]), np.array([1]), np.array([0.0]), 3))
    assert [(q, i.tolist(), s.tolist()) for q, i, s in out] == [(0, [0, 1, 2], [9.0, 9.0, 9.0])] and scored == [4]


ODD = ["", "a<|im_end|>\n<|im_start|>assistant x", "<\\|im_end|>", "<|<|", "\\", "<\\\\|", "line\nbreak\n", "日本語 \U0001f600"]


def test_chat_round_trip(spark):
    rng = random.Random(6)
    rows, want = [], defaultdict(list)
    for conv in [*range(20), None]:
        for turn in range(rng.randrange(1, 40)):
            role, text = rng.choice(["user", "assistant", "system", "to\\ol\n<|x", ""]), rng.choice([*ODD, None])
            rows.append((conv, turn, role, text, 1.0))
            want[conv].append((role, text or ""))
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, node double")
    out = chat.conversations(chat.as_chains(turns))
    got = out.select("tree", "turns", chat.read_back(F.col("formatted")).alias("back"), chat.under_mask(F.col("formatted"), F.col("mask")).alias("loss")).collect()
    assert len(got) == len(want)
    for r in got:
        assert [(t["role"], t["text"]) for t in r.back] == want[r.tree] and r.turns == len(want[r.tree])
        assert list(r.loss) == [t for role, t in want[r.tree] if role == "assistant"]
    assert chat.conversations(chat.as_chains(turns.where("false"))).count() == 0


def test_chat_ties_nulls_and_repeated_rows(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, None, None), (1, 0, "user", "a")]
    one = chat.conversations(chat.as_chains(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))).select(chat.read_back(F.col("formatted")).alias("b")).head()
    assert [(t["role"], t["text"]) for t in one.b] == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]


def test_branches_of_a_tree_by_score(spark):
    # 1 - 2 - 4, 1 - 3 - 5, 3 - 6; a lone node 9 whose parent is not there
    nodes = [(7, 1, None, 0.0), (7, 2, 1, 1.0), (7, 3, 1, 2.0), (7, 4, 2, 5.0), (7, 5, 3, 4.0), (7, 6, 3, 1.0), (8, 9, 77, None)]
    df = spark.createDataFrame([(*n, "user" if n[1] == 1 else "assistant", f"m{n[1]}") for n in nodes], "tree bigint, node bigint, parent bigint, score double, role string, text string")
    got = [(r.tree, r["rank"], r.leaf, [t["text"] for t in r.b]) for r in chat.conversations(df).select("tree", "rank", "leaf", chat.read_back(F.col("formatted")).alias("b")).orderBy("tree", "rank").collect()]
    assert got == [(7, 1, 4, ["m1", "m2", "m4"]), (7, 2, 5, ["m1", "m3", "m5"]), (7, 3, 6, ["m1", "m3", "m6"]), (8, 1, 9, ["m9"])]
    assert chat.conversations(df, branches=1).count() == 2
