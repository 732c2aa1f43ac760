"""Packing, BPE, language ID and page extraction against plain versions."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from casewright.llm import bpe, html, langid, packing

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def test_packing_cuts_every_document_whole_and_pads_little(make_docs, odd_texts, repeated_rows):
    docs = repeated_rows(make_docs(odd_texts))
    rows = packing.pack(docs, BYTE).collect()
    exact = Tokenizer.from_file(BYTE)
    want = {i: exact.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(odd_texts)}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, ids in want.items():
        times = 2 if i < 8 else 1
        assert sum(r.length for r in by_doc[i]) == times * len(ids)
        assert {r.doc_tokens for r in by_doc[i]} == {len(ids)}
        for r in by_doc[i]:
            assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.start : r.start + r.length]
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 1024 or at & (at - 1) == 0 or len(rs) == packing.SEQUENCE_SEGMENTS


def test_packing_keeps_every_limit(make_docs):
    rng = random.Random(1)
    docs = make_docs(["word " * rng.randrange(40) for _ in range(500)])
    rows = packing.pack(docs, BYTE, tokens=128, segments=4, loss_tokens=96, loss_from="key").collect()
    loss, segments, tokens = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        tokens[r.sequence_id] += r.length
        segments[r.sequence_id] += 1
        loss[r.sequence_id] += max(0, min(r.start + r.length, r.doc_tokens - 1) - max(r.start, r.doc_id))
    assert max(tokens.values()) <= 128 and max(segments.values()) <= 4 and max(loss.values()) <= 96
    assert sum(tokens.values()) == sum({r.doc_id: r.doc_tokens for r in rows}.values())


def test_bpe_equals_the_library(make_docs, odd_texts, repeated_rows):
    rng = random.Random(2)
    texts = odd_texts + ["".join(rng.choice("ab thein'sêß \n1½²日́é.K!_İ") for _ in range(40)) for _ in range(200)]
    exact = Tokenizer.from_file(WORD)
    got = bpe.encode(repeated_rows(make_docs(texts)), WORD).collect()
    assert len(got) == len(texts) + 8
    for r in got:
        ids = exact.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert list(r.ids) == ids
        assert r.decoded == exact.decode(ids, skip_special_tokens=False)


def test_rank_tree_is_a_plain_minimum():
    rng = random.Random(3)
    for n in (0, 1, 2, 7, 33):
        ranks = [rng.randrange(5) for _ in range(n)]
        tree = bpe.RankTree(list(ranks))
        for _ in range(50):
            if ranks:
                assert tree.best[1] == min(ranks) and tree.leftmost() == ranks.index(min(ranks))
                i = rng.randrange(n)
                ranks[i] = rng.randrange(6)
                tree.update(i, ranks[i])


def _walked(scores, penalty):
    """Viterbi as in the textbook."""
    n, k = scores.shape
    value, came = scores[0].copy(), []
    for t in range(1, n):
        step = value[:, None] - penalty * (1 - np.eye(k))
        came.append(step.argmax(axis=0))
        value = step.max(axis=0) + scores[t]
    path = [int(value.argmax())]
    for c in reversed(came):
        path.append(int(c[path[-1]]))
    return value.max(), path[::-1]


def test_viterbi_reaches_the_best_value():
    label = langid.Labeller(langid.Model(["a", "b", "c"], np.zeros((langid.BUCKETS, 3), "f4"), {}, 0), 3.0)
    rng = np.random.default_rng(4)
    for n in (1, 2, 9, 40, 200):
        for scale in (0.2, 1.0, 4.0):
            scores = -rng.exponential(scale, (n, 3))
            path = label.path(scores)
            value = scores[np.arange(n), path].sum() - 3.0 * (np.diff(path) != 0).sum()
            assert value == pytest.approx(_walked(scores, 3.0)[0])


def test_language_of_held_out_and_mixed_texts(make_docs, spark):
    rng = random.Random(6)
    own = {"en": ["the", "and", "thing", "with", "over"], "de": ["der", "und", "schaft", "nicht", "über"], "ru": ["это", "как", "что", "для", "они"]}
    langs = [rng.choice(list(own)) for _ in range(300)]
    texts = [" ".join(rng.choice(own[x]) for _ in range(rng.randrange(5, 60))) for x in langs]
    docs = make_docs(texts, langs)
    model = langid.train(docs)
    asked = make_docs([*texts, None, "", "123 !", "ไทย ไทย", " ".join(own["en"] * 8 + own["de"] * 8)], [*langs, *[None] * 5])
    got = {r.doc_id: r for r in langid.predict(asked, model).collect()}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all(got[i].lang_pred == langs[i] for i in held)
    assert [got[300 + i].lang_pred for i in range(3)] == ["und"] * 3 and got[300].score == 0.0
    assert got[303].lang_pred in own and got[303].score == 0.0
    spans = got[304].spans
    assert [s["lang"] for s in spans] == ["en", "de"] and spans[0]["end"] == spans[1]["start"] == len(" ".join(own["en"] * 8)) + 1
    assert [r.lang_pred for r in langid.predict(asked, langid.train(docs.where("false"))).collect()] == ["und"] * 305
    assert langid.predict(docs.where("false"), model).count() == 0
    # numbers of every kind are no letters, and a language without a text is not learned
    numbers = make_docs(["² ½ 12", "Ⅷ ①", "٣ 四", "x²", "ª"])
    assert [r.lang_pred == "und" for r in langid.predict(numbers, model).orderBy("doc_id").collect()] == [True, True, False, False, False]
    assert langid.train(make_docs([None] * 20 + ["a b"] * 20, ["xx"] * 20 + ["yy"] * 20)).languages == ["yy"]
    kept = langid.keep(asked, model, 0.5)
    assert kept.columns == asked.columns and kept.count() == 300 + (got[304].score >= 0.5)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="page with-sidebar"><nav><ul><li><a>Home</a></ul></nav>
<div class="ad">Buy</div><article><header>By me</header><h1>Head &amp; line</h1><p>One <b>two<br>three<p>Four&nbsp;five &lt;tag&gt;
<!-- no --><aside>Related</aside><form><input>Name</form><script>var x = "</p>";</script><ul><li>six<li class="share">Share<li>seven</ul>
<section id="comments"><p>Nice!</section></article><footer>&copy; us</footer></body>"""


def test_page_without_its_frame():
    assert html.blocks_of(PAGE) == (["Head & line", "One two three", "Four five <tag>", "six", "seven"], True)
    assert html.blocks_of("") == ([], False)
    assert html.blocks_of("<p>cut <b") == (["cut"], False)
    assert html.blocks_of('<div class="with-sidebar"><div id="sidebar">x</div><p>text</div>') == (["text"], False)


def test_main_text_beside_an_article_stays():
    page = "<p>Out</p><main><h1>Head</h1><p>Lead</p><article><p>Body</p></article><nav>Menu</nav><p>End</p></main>"
    assert html.blocks_of(page) == (["Head", "Lead", "Body", "End"], True)
    assert html.blocks_of("<main><p>Whole body</p></main><div><article>Teaser</article></div>") == (["Whole body", "Teaser"], True)


def test_host_suffix_array_keeps_unique_runs(spark):
    rng = random.Random(7)
    line = "All rights reserved by the owners of this small site"
    own = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(200)]
    rows = [(i, f"http://h.example/{i}", f"<div>Menu of all our pages</div><div>{t}</div><div>{line}</div>", "x") for i, t in enumerate(own)]
    rows += [(500, None, None, "x"), (501, "::", "", "x"), (502, "http://one.example/", f"<div>{line}</div>", "x"), (503, "http://h.example/a", PAGE, "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = {r.page_id: r.text for r in html.extract(pages.unionByName(pages.where("page_id = 500"))).collect()}
    assert all(got[i] == t for i, t in enumerate(own))
    assert (got[500], got[501], got[502]) == ("", "", line)
    assert html.extract(pages.where("false")).count() == 0


def test_host_counts_runs_over_all_its_pages(spark):
    rng = random.Random(9)
    notice = "Our office is closed for the whole of next week"
    own = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(20)) for _ in range(640)]
    some, pair = (3, 200, 411, 630), "A line that only two pages of this host have"
    texts = [f"<div>{t}</div>" + (f"<div>{notice}</div>" if i in some else "") + (f"<div>{pair}</div>" if i in (5, 6) else "") for i, t in enumerate(own)]
    texts += [texts[5]] * 5  # equal streams are one page
    rows = [(i, f"http://h.example/{i}", t) for i, t in enumerate(texts)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert [got[i] for i in some] == [own[i] for i in some]
    assert len(got) == len(rows) and all(got[i] == f"{own[5]}\n\n{pair}" for i in (5, *range(640, 645))) and got[6] == f"{own[6]}\n\n{pair}"


def _extracted(spark, htmls, url="http://h.example/{}"):
    rows = [(i, url.format(i), h) for i, h in enumerate(htmls)]
    return [r.text for r in html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).orderBy("page_id").collect()]


def test_a_teaser_marks_no_page(spark):
    page = '<div class="story"><p>Main text here</p></div><article class="card"><p>Teaser</p></article>'
    assert _extracted(spark, [page]) == ["Main text here\n\nTeaser"]
    links = '<div class="x1"><a href="/">A long list</a> <a href="/b">of many other links beside it</a></div>'
    assert html.blocks_of(f"{links}<article><p>Short text</p></article>") == (["Short text"], True)


def test_names_inside_an_article_count_whole():
    keep = '<article><div class="social-history">One</div><p class="share-capital">Two</p><p id="notice">Three</p><h2 id="comments">Four</h2><div class="menu-prices">Five</div>'
    drop = '<div class="share-buttons">x</div><div id="relatedPosts">x</div><p class="notice">x</p><div class="ad-slot-2">x</div><ul class="comment__list">x</ul></article>'
    assert html.blocks_of(keep + drop) == (["One", "Two", "Three", "Four", "Five"], True)
    assert html.blocks_of('<div class="social-history">One</div><div class="left-sidebar-x">x</div>') == (["One"], False)


def test_copies_of_an_article_are_one_page(spark):
    rng = random.Random(11)
    article = " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))
    own = [" ".join(f"v{rng.randrange(10**6)}" for _ in range(8)) for _ in range(3)]
    got = _extracted(spark, [f"<div>{article}</div><div>{t}</div>" for t in own])
    assert got == [f"{article}\n\n{t}" for t in own]
    # versions whose bodies differ: what would leave less than half of a page stays, short lines go
    parts = [" ".join(f"u{rng.randrange(10**6)}" for _ in range(30)) for _ in range(3)]
    line = "This line stands on all of our pages"
    pages = ["".join(f"<div>{p}</div>" for p in parts) + f"<div>{t} {' '.join(map(str, range(30)))} {t}</div><div>{line}</div>" for t in own]
    for text, t in zip(_extracted(spark, pages), own):
        assert text.split("\n\n")[:3] == parts and t in text and line not in text


def test_a_line_in_every_article_goes(spark):
    rng = random.Random(12)
    line, passage = "Get our letter into your box every week", "A passage that some of the pages quote word by word"
    own = [[" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(3)] for _ in range(20)]
    htmls = [f'<main><p>{a}</p><p>{b}</p><div class="css-1x2y">{line}</div>' + (f"<p>{passage}</p>" if i < 6 else "") + f"<p>{c}</p></main>" for i, (a, b, c) in enumerate(own)]
    want = ["\n\n".join([a, b, *([passage] if i < 6 else []), c]) for i, (a, b, c) in enumerate(own)]
    assert _extracted(spark, htmls) == want
    # copies of one article at many addresses lose nothing, nor do pages of hosts of their own
    assert _extracted(spark, htmls[:1] * 20) == [f"{own[0][0]}\n\n{own[0][1]}\n\n{line}\n\n{passage}\n\n{own[0][2]}"] * 20
    assert all(line in t for t in _extracted(spark, htmls, "http://h{}.example/"))


def test_unmarked_pages_are_those_of_a_plain_count(spark):
    rng = random.Random(8)
    pages = []
    for i in range(240):
        blocks = [[rng.choice("abc") for _ in range(rng.randrange(1, 9))] for _ in range(rng.randrange(1, 4))]
        pages.append([[f"p{rng.randrange(200)}" for _ in range(25)], *blocks])
    pages += pages[:9]
    got = _extracted(spark, ["".join(f"<div>{' '.join(b)}</div>" for b in p) for p in pages])
    bodies = defaultdict(set)
    streams = [[t for b in p for t in ("\n", *b)] for p in pages]
    for s, p in zip(streams, pages):
        for i in range(len(s) - html.RUN + 1):
            bodies[tuple(s[i : i + html.RUN])].add(tuple(p[0]))
    for s, text in zip(streams, got):
        gone = set()
        for i in range(len(s) - html.RUN + 1):
            if len(bodies[tuple(s[i : i + html.RUN])]) >= html.PAGES:
                gone.update(range(i, i + html.RUN))
        left = "".join("\n\n" if t == "\n" else f" {t} " for i, t in enumerate(s) if t == "\n" or i not in gone)
        assert text == "\n\n".join(" ".join(b.split()) for b in left.split("\n\n") if b.strip())
    assert sum(t.count(" ") for t in got) < sum(len(s) for s in streams) - 300
