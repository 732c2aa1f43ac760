"""Main text of web pages, by structure and by a suffix array over each host's pages.

A page is cut into blocks. Blocks inside elements that never hold main text (menus, footers, forms, adverts,
comments, …) go. A main, or articles that hold more words than the blocks beside them, mark the main text; other pages are
unmarked (a teaser in an article element marks nothing). Blocks beside a marked main text go.

The host decides about undecided blocks: the undecided token streams of a host's pages are concatenated, a suffix array
over them, sorted by prefix doubling, finds every substring of ``RUN`` tokens or more that at least ``PAGES`` distinct
pages share, covered tokens are removed as boilerplate, and the unique runs are kept. Repetition is weighed by place:

* Pages are distinct if their bodies are, the body being the block with most words outside links. So copies of an article
  are one page, however many addresses they have, and their text is not boilerplate for being copied.
* In an unmarked page all blocks are undecided. If less than half of a page's words outside links were left, it is itself
  a copy: its blocks of ``PROSE`` such words or more stay whole.
* In a marked page only blocks that ``PAGES`` and at least half of the host's distinct marked pages hold word for word, and that
  are not the page's body, are undecided: the line that a site puts into every article. Quoted passages are main text.

A host's distinct undecided streams are dealt into groups of about ``TOGETHER``, as many groups as their number needs,
so a host with a third of all pages is many small groups. Each group has its own suffix array and names the bodies
of its runs of ``RUN`` tokens; distinct bodies are counted over all groups of the host, and the host's counts decide.

Names: outside articles a layout word anywhere in a class, id or role leaves an element out. Other words, and all words
inside an article or main, do so only where the whole name is made of such words and of neutral ones ("share-buttons", but not
"share-capital"), and the id of a paragraph, heading or cell is an anchor, not a name.

Defined results: a null or empty html gives an empty text; repeated pages give repeated rows, and pages with the same
stream count as one page when runs are counted; a null or odd url belongs to the host ''; unclosed elements end where
HTML ends them, or with the page; an empty table gives an empty result; other columns are not read. Streams, blocks, bodies and
runs are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import html as entities
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from casewright.llm.shared import SEEDS, by_rows, cut_lineage, mix

RUN = 6
PAGES = 3
TOGETHER = 64
PROSE = 20

PARSED = "page_id bigint, url string, blocks array<string>, prose array<int>, marked boolean"

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"']|["'])*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_CLASS_PART = re.compile(r"[a-z]+")
_HAS = re.compile(r"(?<!\S)(?:with|has|have|no|not|without|hide|is)[-_]\S*")

# Fixed names of HTML elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
NEVER = frozenset("nav header footer aside form button select option datalist dialog menu svg canvas object head fieldset legend label output audio video map".split()) | RAW
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table caption tbody td tfoot th thead tr ul".split()
)
CLOSES_ITSELF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
HOLDS = frozenset("article main div section body html td th table ul ol dl aside nav header footer form figure blockquote".split())
# Fixed words of class, id and role names.
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist tooltip".split())
LAYOUT = frozenset("nav navbar navigation menu header footer sidebar banner masthead topbar toolbar".split())
ASIDE = LAYOUT | frozenset(
    "ad ads advert adverts advertisement adverting advertising sponsor sponsored promo promotion breadcrumb breadcrumbs cookie cookies consent gdpr notice notices newsletter subscribe subscription signup login popup modal overlay share sharing social related recommended recommendations comment comments commentlist disqus pagination pager widget copyright disclaimer skip".split()
)

# Fixed words of class and id names that say nothing of a part by themselves.
NEUTRAL = frozenset(
    "area bar block body bottom box btn button buttons card cards col column container content cover desktop entry first fixed footer frame global group header heading holder icon icons inline inner item items js label large last layout left line link links list lists main message mobile module outer page panel post posts primary region right row section secondary simple site slot small sticky strip tab tabs tag text title tools top unit view wrap wrapper".split()
)
# Elements whose id is an anchor within the text.
ANCHORS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr blockquote pre figure figcaption a b i em strong span".split())


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(source)}


def _aside(attributes: dict[str, str], tag: str, words: frozenset[str], strict: bool) -> bool:
    """Whether attributes leave an element out. With ``strict``, layout words count in whole names only."""
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return True
    if attributes.get("role", "").lower() in ROLES:
        return True
    names = attributes.get("class", "") if strict and tag in ANCHORS else f"{attributes.get('class', '')} {attributes.get('id', '')}"
    names = re.sub(r"([a-z])([A-Z])", r"\1-\2", names).lower()
    for name in _HAS.sub(" ", names).split():  # "with-sidebar" is not a sidebar
        parts = _CLASS_PART.findall(name)
        hits = [p for p in parts if p in words]
        if hits and (not strict and any(p in LAYOUT for p in hits) or all(p in words or p in NEUTRAL or len(p) == 1 for p in parts)):
            return True
    return False


def blocks_of(page: str) -> tuple[list[str], bool]:
    """The page's blocks that may be main text, and whether it marked its article."""
    blocks, _, marked = parsed(page)
    return blocks, marked


def parsed(page: str) -> tuple[list[str], list[int], bool]:
    """The page's blocks that may be main text, their words outside links, and whether it marked its main text.

    Each open element is kept with the state before it: whether its text is left out, whether that is only because
    of a layout name (a wrapper "with-sidebar" still holds the article), whether it lies in an article or a main, and
    whether it lies in a link.
    """
    found: list[tuple[str, int, int]] = []  # text, 2 in an article, 1 in a main, 0 elsewhere, words outside links
    open_: list[tuple[str, tuple[bool, bool, int, bool]]] = []
    out, layout, inside, link = False, False, 0, False
    now: list[str] = []
    linked = 0

    def end_block():
        nonlocal linked
        if now:
            words = entities.unescape("".join(now)).split()
            if words:
                found.append((" ".join(words), inside, max(0, len(words) - linked)))
            now.clear()
        linked = 0

    def keep(text: str):
        nonlocal linked
        now.append(text)
        if link:
            linked += len(text.split())

    def pop_to(k: int):
        nonlocal out, layout, inside, link
        out, layout, inside, link = open_[k][1]
        del open_[k:]

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            if not out:
                keep(page[at:])
            break
        if not out and m.start() > at:
            keep(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            k = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == tag), -1)
            if tag in BLOCK:
                end_block()
            if k >= 0:
                if any(t in BLOCK for t, _ in open_[k:]):
                    end_block()
                pop_to(k)
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else n
            continue
        if tag in VOID:
            if tag == "hr":
                end_block()
            elif tag == "br" and not out:
                now.append(" ")
            continue
        if tag in BLOCK:
            end_block()
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == "p":
                    pop_to(i)
                    break
                if open_[i][0] in HOLDS:
                    break
        if tag in CLOSES_ITSELF:
            same = {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag}
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] in same:
                    pop_to(i)
                    break
                if open_[i][0] in CLOSES_ITSELF[tag]:
                    break
        if m[3].rstrip().endswith("/") and tag in ("svg", "path", "use"):
            continue
        open_.append((tag, (out, layout, inside, link)))
        link = link or tag == "a"
        attributes = _attributes(m[3]) if m[3].strip() else {}
        main = attributes.get("role") == "main"
        if tag in ("article", "main") or main or attributes.get("itemprop") == "articleBody":
            if out and layout:
                out = layout = False
            inside = max(inside, 1 if tag == "main" or main else 2)
            words = ASIDE - LAYOUT
        else:
            words = ASIDE
        if not out and tag not in ("html", "body"):
            if tag in NEVER:
                out, layout = True, False
            elif attributes and _aside(attributes, tag, words, inside > 0):
                out, layout = True, not _aside(attributes, tag, words - LAYOUT, inside > 0)
    end_block()
    within, beside = (sum(n for _, i, n in found if (i > 0) == side) for side in (True, False))
    marked = any(i == 1 for _, i, _ in found) or (any(i for _, i, _ in found) and within >= beside)
    found = [f for f in found if f[1] > 0 or not marked]
    return [t for t, _, _ in found], [n for _, _, n in found], marked


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _ranked(streams: list[list[int]], run: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each suffix of the concatenation by its first ``run`` tokens, and where each stream begins.

    The suffix array is sorted by prefix doubling up to ``run`` tokens: suffixes of equal rank share so many.
    """
    sizes = np.array([len(s) for s in streams])
    # one end mark for each stream, which no other token equals
    top = max(max(s, default=0) for s in streams) + 1
    rank = np.concatenate([np.append(np.asarray(s, dtype=np.int64), top + k) for k, s in enumerate(streams)])
    n, length = len(rank), 1
    while length < run:
        step = min(length, run - length)
        after = np.full(n, -1, dtype=np.int64)
        after[: n - step] = rank[step:]
        array = np.lexsort((after, rank))
        new = np.concatenate([[0], np.cumsum((np.diff(rank[array]) != 0) | (np.diff(after[array]) != 0))])
        rank[array] = new
        length += step
    return rank, np.cumsum(sizes + 1) - sizes - 1


def _tokens(blocks, undecided=None) -> list[str]:
    """A page's stream, of its undecided blocks or of all. A block's start is a token too."""
    return [t for k in (range(len(blocks)) if undecided is None else undecided) for t in ("\n", *blocks[k].split(" "))]


def _run_hashes(tokens: list[str], known: dict[str, int]) -> np.ndarray:
    """Hashes of a stream's runs of ``RUN`` tokens."""
    for t in tokens:
        if t not in known:
            known[t] = int.from_bytes(hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    h = np.array([known[t] for t in tokens], dtype=np.uint64)
    n = max(0, len(h) - RUN + 1)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(RUN if n else 0):
            out = mix(out + SEEDS[0]) ^ h[k : k + n]
        return mix(out).view(np.int64)


def _bodies_of_runs(group: pd.DataFrame) -> pd.DataFrame:
    """Each run of a group's streams with each body that has it."""
    known: dict[str, int] = {}
    numbers: dict[str, int] = {}
    words = [_tokens(b, u) for b, u in zip(group["blocks"], group["undecided"])]
    rank, begins = _ranked([[numbers.setdefault(t, len(numbers)) for t in w] for w in words], RUN)
    spans = [max(0, len(w) - RUN + 1) for w in words]
    at = np.concatenate([b + np.arange(n) for b, n in zip(begins, spans)]).astype(np.int64)
    body = np.repeat(group["body"].to_numpy(dtype=np.int64), spans)
    hashes = np.concatenate([_run_hashes(w, known) for w in words])
    order = np.lexsort((body, rank[at]))
    r, b = rank[at][order], body[order]
    first = (np.diff(r, prepend=-1) != 0) | np.append(True, np.diff(b) != 0)[: len(b)]
    return pd.DataFrame({"host": group["host"].iloc[0], "part": group["part"].iloc[0], "run": hashes[order][first], "body": b[first]})


def _unique_runs(group: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
    """Texts of one group's streams without the runs their host repeats."""
    known: dict[str, int] = {}
    repeated = shared["run"].to_numpy(dtype=np.int64)
    texts = []
    for blocks, prose, undecided in zip(group["blocks"], group["prose"], group["undecided"]):
        tokens = _tokens(blocks, undecided)
        gone = np.zeros(len(tokens), dtype=bool)
        for i in np.flatnonzero(np.isin(_run_hashes(tokens, known), repeated)):
            gone[i : i + RUN] = True
        kept = [b.split(" ") for b in blocks]
        at = 0
        for k in undecided:
            at += 1
            kept[k] = [w for w, left_out in zip(kept[k], gone[at : at + len(kept[k])]) if not left_out]
            at += blocks[k].count(" ") + 1
        # of a block that is partly links, the share of its words outside them is taken for what is left of it
        left = sum(len(w) * n / (b.count(" ") + 1) for w, n, b in zip(kept, prose, blocks))
        if 2 * left < sum(prose):
            kept = [b.split(" ") if n >= PROSE else w for w, n, b in zip(kept, prose, blocks)]
        texts.append("\n\n".join(" ".join(w) for w in kept if w))
    return pd.DataFrame({"host": group["host"], "stream": group["stream"], "text": texts})


def _lines_of_hosts(streams: DataFrame) -> DataFrame:
    """``(host, stream, undecided)`` of marked streams with blocks that most of their host's distinct pages hold."""
    # one hash for a block; a word that a page repeats makes no second page
    blocks = streams.select("host", "stream", "body", F.posexplode(F.transform("blocks", lambda b: F.when(F.size(F.split(b, " ")) >= RUN - 1, F.xxhash64(b)))).alias("place", "block"))
    blocks = blocks.where("block is not null and block != body")
    often = blocks.groupBy("host", "block").agg(F.count_distinct("body").alias("n")).where(F.col("n") >= PAGES)
    pages = streams.groupBy("host").agg(F.count_distinct("body").alias("pages"))
    lines = cut_lineage(often.join(pages, "host").where(F.col("n") * 2 >= F.col("pages")).select("host", "block"))
    return blocks.join(lines, ["host", "block"]).groupBy("host", "stream").agg(F.sort_array(F.collect_set("place")).alias("undecided"))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, text)`` for every page."""
    columns = pages.select(F.col(page_id).cast("bigint").alias("a"), F.col(url).alias("b"), F.coalesce(F.col(html), F.lit("")).alias("c"))

    def make():
        return lambda key, address, page: [(key, address, *parsed(page))]

    found = cut_lineage(by_rows(columns, make, PARSED))
    body = F.xxhash64(F.element_at("blocks", (F.array_position("prose", F.array_max("prose"))).cast("int")))
    keyed = found.withColumns({"host": host_of(F.col("url")), "stream": F.xxhash64("blocks", "prose", "marked")})
    some = keyed.where(F.size("blocks") > 0).withColumn("body", body)
    lines = cut_lineage(_lines_of_hosts(some.where("marked")))
    open_ = some.where("not marked").withColumn("undecided", F.sequence(F.lit(0), F.size("blocks") - 1))
    asked = open_.unionByName(some.where("marked").join(lines, ["host", "stream"]).select(*open_.columns))
    streams = cut_lineage(asked.select("host", "stream", "blocks", "prose", "undecided", "body").dropDuplicates(["host", "stream"]))
    # only hosts of more than one group bear a number, so the table is a small part of the streams
    groups = streams.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / TOGETHER).alias("groups")).where("groups > 1")
    dealt = cut_lineage(streams.join(groups, "host", "left").withColumn("part", F.pmod("stream", F.coalesce("groups", F.lit(1)))).drop("groups"))
    runs = cut_lineage(dealt.groupBy("host", "part").applyInPandas(_bodies_of_runs, "host string, part bigint, run bigint, body bigint"))
    often = runs.groupBy("host", "run").agg(F.count_distinct("body").alias("pages")).where(F.col("pages") >= PAGES).select("host", "run")
    shared = runs.select("host", "part", "run").distinct().join(often, ["host", "run"])
    texts = cut_lineage(dealt.groupBy("host", "part").cogroup(shared.groupBy("host", "part")).applyInPandas(_unique_runs, "host string, stream bigint, text string"))
    # a stream without a text of its own keeps its blocks as they are
    full = keyed.where(F.size("blocks") > 0).join(texts, ["host", "stream"], "left").select("page_id", "url", F.coalesce("text", F.array_join("blocks", "\n\n")).alias("text"))
    return full.unionByName(keyed.where(F.size("blocks") == 0).select("page_id", "url", F.lit("").alias("text")))
