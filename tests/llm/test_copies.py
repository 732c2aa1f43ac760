"""Near-dedup, substring dedup, secrets and the pipeline against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from casewright.llm import neardup, secrets, shared, substring


def _shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else None


def _classes(texts):
    sets, comp = [_shingles(t) for t in texts], list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            if sets[a] and sets[b]:
                both = sum((sets[a] & sets[b]).values())
                if both >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - both) and comp[a] != comp[b]:
                    low, high = sorted((comp[a], comp[b]))
                    comp = [low if c == high else c for c in comp]
    return comp


def _changed(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def test_near_duplicates_are_the_components_of_a_full_comparison(make_docs, odd_texts):
    rng = random.Random(1)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    other = [f"v{rng.randrange(10**6)}" for _ in range(300)]
    # copies of one base that are near the base, and many of them not near each other
    texts = odd_texts + [_changed(rng, base, rng.choice((1, 3, 5, 6, 9, 20))) for _ in range(150)] + [" ".join(base)] + [_changed(rng, other, 6) for _ in range(40)] + ["q w e r t y"] * 30
    got = {r.doc_id: r for r in neardup.classes(make_docs(texts)).collect()}
    assert [got[i].class_id for i in range(len(texts))] == _classes(texts)


def test_pairs_whose_sketches_agree_by_chance_in_an_earlier_band(spark):
    rng = np.random.default_rng(4)
    signed = rng.integers(0, 2**31, neardup.COORDINATES).astype(np.int32)
    other = signed.copy()
    other[:4] ^= 1 << 20  # the same bytes, but not the same band
    rows = [(node, s.astype(np.uint8).tobytes(), neardup.band_hashes(s).tolist()) for node, s in ((1, signed), (2, other))]
    assert rows[0][1] == rows[1][1] and [a == b for a, b in zip(rows[0][2], rows[1][2])] == [False] + [True] * 29
    members = spark.createDataFrame(rows, "node bigint, sketch binary, bands array<bigint>")
    shared_buckets = [(rows[0][2][b], b, node, node, 1, 1, node == 2) for b in range(1, 30) for node in (1, 2)]
    mixed = spark.createDataFrame(shared_buckets, "bucket bigint, band int, node bigint, comp bigint, n_main bigint, n_other bigint, asks boolean")
    bodies = spark.createDataFrame([(1, "one text of a few words"), (2, "one text of a few words")], "node bigint, text string")
    assert [tuple(r) for r in neardup._asked(mixed, members, bodies, 0.8).collect()] == [(1, 2)]


def test_near_duplicate_rows_of_one_id(make_docs, repeated_rows, odd_texts):
    docs = repeated_rows(make_docs(odd_texts))
    assert neardup.classes(docs).count() == docs.count()
    kept = neardup.kept(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == sorted(set(_classes(odd_texts)))
    assert neardup.classes(docs.where("false")).count() == 0 and neardup.kept(docs.where("false")).count() == 0


def test_classes_that_share_their_smallest_id_stay_apart(make_docs, spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    docs = make_docs([one, one, two, three, three, "", "!"])
    for ids in ({0: 7, 1: 9, 2: 7}, {0: 9, 1: 7, 2: 9}, {0: 7, 1: 7, 2: 9, 3: 7}, dict.fromkeys(range(7))):
        rows = [(ids.get(r.doc_id, r.doc_id + 100), *r[1:]) for r in docs.collect()]
        renamed = spark.createDataFrame(rows, docs.schema)
        # two wordless texts and three others: one row of each, whatever the ids
        assert sorted(r.text for r in neardup.kept(renamed).collect()) == sorted([one, two, three, "", "!"])
        bodies = {r.body: r.class_id for r in neardup.classes(renamed).collect()}
        assert len(bodies) == len(set(bodies.values())) == 5


def test_the_row_kept_of_equal_texts_does_not_depend_on_their_order(make_docs, spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = make_docs([text]).drop("source").crossJoin(spark.createDataFrame([(f"s{i}", {"k": i % 2}) for i in range(40)], "source string, more map<string,int>"))
    got = {r.source for n in (1, 3, 7) for order in ("asc", "desc") for r in neardup.kept(docs.orderBy(getattr(docs.source, order)()).repartition(n)).collect()}
    assert len(got) == 1 and got <= {f"s{i}" for i in range(40)}


def test_dart_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(2)
    elements = rng.integers(1, 2**63, 400).astype(np.uint64)
    elements.sort()
    for share in (0.5, 0.8):
        a, b = rng.uniform(0.2, 3.0, 400), rng.uniform(0.2, 3.0, 400)
        b = np.where(rng.random(400) < share, a, b)
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        got = (neardup.signature(elements, a, 3000) == neardup.signature(elements, b, 3000)).mean()
        assert got == pytest.approx(want, abs=0.035)
    assert (neardup.signature(elements[:1], np.array([1.0])) == neardup.signature(elements[:1], np.array([1.0]))).all()


def test_components_of_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1001 + i) for i in range(50)]
    got = {r.node: r.comp for r in shared.components(spark.createDataFrame(path + star + [(5, 5)], "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1051)}}


def _kept(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    counts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - window + 1) if counts[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def test_repeated_windows_are_those_of_a_full_count(make_docs, odd_texts, monkeypatch):
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(50)]
    texts = list(odd_texts)
    for _ in range(60):
        own = [rng.choice("abcdefg") + str(rng.randrange(3000)) for _ in range(rng.randrange(80))]
        cut = rng.randrange(0, 12)
        texts.append(" ".join([*own, *passage[cut : cut + rng.randrange(20, 45)], *own[:20]]))
    texts += ["u v w x y " * 20, "k l m " * 13, " ".join(f"z{i}" for i in range(34)), " ".join(rng.choice("ab") for _ in range(600))]
    docs = make_docs(texts)
    for together in (substring.TOGETHER, 4):  # hot keys dealt over several automata give the same
        monkeypatch.setattr(substring, "TOGETHER", together)
        got = {r.doc_id: (r.words, r.removed, r.kept) for r in substring.clean(docs).select("row.doc_id", "words", "removed", "kept").collect()}
        assert [got[i] for i in range(len(texts))] == _kept(texts, substring.WINDOW)


def test_equal_rows_repeat_each_other(make_docs):
    text = " ".join(f"r{i}" for i in range(40))
    docs = make_docs([text, "short"])
    assert [r.removed for r in substring.clean(docs).orderBy("row.doc_id").collect()] == [0, 0]
    assert [r.removed for r in substring.clean(docs.unionByName(docs)).orderBy("row.doc_id").collect()] == [40, 40, 0, 0]
    assert substring.clean(docs.where("false")).count() == 0


def test_null_and_repeated_ids_are_rows_like_any_other(make_docs):
    texts = [" ".join(f"r{i}" for i in range(60)), "a " + " ".join(f"r{i}" for i in range(60)), " ".join(f"s{i}" for i in range(50))]
    for ids in ("null", "null, 2", "7, 7", "-9223372036854775808, null"):
        listed = [x.strip() for x in ",".join([ids] * 3).split(",")][:3]
        docs = make_docs(texts).withColumn("doc_id", F.expr(f"element_at(array({', '.join(f'cast({x} as bigint)' for x in listed)}), cast(doc_id + 1 as int))"))
        got = sorted((r.words, r.removed) for r in substring.clean(docs).collect())
        assert got == [(50, 0), (60, 60), (61, 60)]


def test_texts_of_little_variety_come_in_bounded_stretches(make_docs):
    hashes = substring.Hasher()(["alpha beta gamma".split()[i % 3].encode() for i in range(30000)])
    assert substring.stretches_of(hashes)[3].max() == substring.MOST_WINDOWS
    rng = random.Random(8)
    texts = ["alpha beta gamma " * 1300, "x " * 3000, "one " + "x " * 1100 + "two", " ".join(rng.choice("ab") for _ in range(3000)), "end " + "alpha beta gamma " * 11]
    got = {r.doc_id: (r.words, r.removed, r.kept) for r in substring.clean(make_docs(texts)).select("row.doc_id", "words", "removed", "kept").collect()}
    assert [got[i] for i in range(len(texts))] == _kept(texts, substring.WINDOW)


def test_automaton_counts_occurrences():
    rng = random.Random(4)
    for _ in range(40):
        texts = [[rng.choice("ab") for _ in range(rng.randrange(1, 14))] for _ in range(rng.randrange(1, 5))]
        times = [rng.randrange(1, 4) for _ in texts]
        shard = substring.Automaton()
        for t, n in zip(texts, times):
            shard.add(t, n)
        shard.count()
        counts = Counter()
        for t, n in zip(texts, times):
            for i in range(len(t) - 3):
                counts[tuple(t[i : i + 4])] += n
        for t in texts:
            assert list(shard.statistics(t, 4)) == [counts[tuple(t[i : i + 4])] for i in range(len(t) - 3)]


ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def _spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out))


SECRET_TEXTS = [
    None, "", "Password: hunter22x", "passwd='short' token: token: abcdefghij", "api_key=APIKEY = \"aa/bb+cc==dd\"", "é日\U0001f600 secret=abcdefgh1 é AKIA" + "A" * 12,
    "AKIAAKIA1234 AKIA123456789012345 x" + "0123456789abcdef" * 3, "token=" + "ab" * 20 + " AKIA" + "B" * 11, "deadbeef" * 4 + "g" + "f" * 31, "tokentoken=aaaaaaaa=token=bbbbbbbb",
]


def test_secret_spans_and_redaction(make_docs, repeated_rows):
    from pyspark.sql import functions as F

    docs = repeated_rows(make_docs(SECRET_TEXTS))
    found, ledger = secrets.findings(docs)
    rows = found.select("row.doc_id", "row.text", secrets.listed(F.col("found")).alias("spans"), secrets.redacted(F.col("row.text"), F.col("found")).alias("clean")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.spans == _spans(SECRET_TEXTS[r.doc_id] or "")
        assert (r.clean is None) == (r.text is None)
        if r.clean is not None:
            assert r.clean.count("[SECRET]") <= len(r.spans.split(",")) and _spans(r.clean) == ""
    assert secrets.findings(docs.where("false"))[0].count() == 0


def test_ledger_scans_only_unseen_pairs(make_docs):
    from dataclasses import replace

    first, second = make_docs(SECRET_TEXTS[:6]), make_docs(SECRET_TEXTS)
    ledger = secrets.scan(first)
    blobs = len({t or "" for t in SECRET_TEXTS[:6]})
    assert ledger.count() == 3 * blobs
    assert secrets.scan(first, ledger=ledger).count() == 0
    found, new = secrets.findings(second, ledger=ledger)
    assert new.count() == 3 * (len({t or "" for t in SECRET_TEXTS}) - blobs)
    from pyspark.sql import functions as F

    assert {r.doc_id: r.s for r in found.select("row.doc_id", secrets.listed(F.col("found")).alias("s")).collect()} == {i: _spans(t or "") for i, t in enumerate(SECRET_TEXTS)}
    newer = (replace(secrets.RULES[0], version=2), *secrets.RULES[1:])
    assert secrets.scan(first, rules=newer, ledger=ledger).count() == blobs


def test_pipeline_stage_by_stage(make_docs, spark):
    rng = random.Random(9)
    own = {"en": ["the", "and", "thing", "with", "over", "is"], "de": ["der", "und", "schaft", "nicht", "über", "ist"]}
    langs = [rng.choice(list(own)) for _ in range(60)]
    texts = [" ".join(rng.choice(own[x]) + (str(rng.randrange(10**6)) if rng.random() < 0.6 else "") for _ in range(120)) for x in langs]
    shared_passage = " ".join(f"the thing{i}" for i in range(30))
    texts[5], texts[9], texts[11] = texts[4], f"{texts[9]} {shared_passage}", f"{shared_passage} {texts[11]} password = hunter2hunter2"
    texts += [None, "", "12 34"]
    docs = make_docs(texts, [*langs, None, None, None])
    one = docs
    steps = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        one = shared.cut_lineage(stage(spark, one, ""))
        assert one.columns == docs.columns
        steps.append({r.doc_id: r.text for r in one.collect()})
    assert set(steps[0]) == set(range(60))
    assert set(steps[1]) == {i for i, c in enumerate(_classes(texts[:60])) if c == i} and 5 not in steps[1]
    left = sorted(steps[1])
    assert [steps[2][i].split() for i in left] == [k[2].split() for k in _kept([steps[1][i] for i in left], 35)]
    assert "[SECRET]" in steps[3][11] and "hunter2" not in steps[3][11]
    assert all(r.n_chars == len(r.text) for r in one.collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, one, "")
    assert {r.doc_id for r in packed.collect()} == set(left)
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
