"""Language identification of whole texts, with spans of mixed-language text.

A word's script, found from ranges of code points, narrows the languages it can belong to. Each candidate gets a
score from hashed character n-grams, and Viterbi over the words, with a penalty for each switch, labels spans. The
predicted language is the one whose spans hold the most letters, and the score is their share of all letters.

The model is naive Bayes over n-grams of ``SAMPLE_ROWS`` labelled rows a language (in expectation; rows are taken by a
hash of the id), counted by Spark and held as one row of ``BUCKETS`` weights a language, whatever the corpus. Rows of
the held-out part never count.

Viterbi is exact but seldom walks: if no other language gains as much as one penalty on any stretch of words, staying
in one language is the best path, and running minima show that for a whole text at once.

Defined results: a text that is null, empty or without letters is ``und`` with score 0; a text whose letters are all
of scripts never seen gets the most frequent learned language with score 0; with no labelled row every text is
``und``; ties go to the language first in order; repeated rows are predicted each; a null id is not held out; columns
other than those named are not read.
"""

from __future__ import annotations

import re
import sys
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casewright.llm.shared import by_rows

SAMPLE_ROWS = 4000
BUCKETS = 1 << 16
SWITCH_PENALTY = 12.0
#: A word's score for a language lies at most so far below the best one's.
FLOOR = 8.0
REMEMBERED = 400_000
UNDETERMINED = "und"

# First and last code point of a script's main blocks.
SCRIPTS = (
    (0x0041, 0x024F, "Latin"),
    (0x0370, 0x03FF, "Greek"),
    (0x0400, 0x052F, "Cyrillic"),
    (0x0530, 0x058F, "Armenian"),
    (0x0590, 0x05FF, "Hebrew"),
    (0x0600, 0x077F, "Arabic"),
    (0x0900, 0x097F, "Devanagari"),
    (0x0980, 0x09FF, "Bengali"),
    (0x0B80, 0x0BFF, "Tamil"),
    (0x0E00, 0x0E7F, "Thai"),
    (0x10A0, 0x10FF, "Georgian"),
    (0x1E00, 0x1EFF, "Latin"),
    (0x1F00, 0x1FFF, "Greek"),
    (0x3040, 0x30FF, "Kana"),
    (0x3400, 0x4DBF, "Han"),
    (0x4E00, 0x9FFF, "Han"),
    (0xAC00, 0xD7AF, "Hangul"),
)
_FIRST = np.array([s[0] for s in SCRIPTS])
# The category classes take numbers such as superscripts, fractions and Roman numerals for word characters. A text that
# has any, which one fast search tells, is split by a pattern that names them all.
_NUMBERS = "".join(c for c in map(chr, range(0x80, sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
_HAS_NUMBER = re.compile("[" + "".join(c for c in _NUMBERS if c < "\U00010000") + "]")  # a table, where characters beyond it would not be
_HAS_ASTRAL = re.compile("[\U00010000-\U0010ffff]")
_WORD_BESIDE_NUMBERS = re.compile(rf"[^\W\d_{_NUMBERS}]+")
_WORD, _ASCII_WORD = re.compile(r"[^\W\d_]+"), re.compile("[A-Za-z]+")
PREDICTED = "doc_id bigint, lang_pred string, score double, spans array<struct<start:bigint,end:bigint,lang:string>>"


def words_in(text: str) -> re.Pattern:
    """The pattern of the text's words, runs of letters."""
    if text.isascii():
        return _ASCII_WORD
    return _WORD_BESIDE_NUMBERS if _HAS_NUMBER.search(text) or _HAS_ASTRAL.search(text) else _WORD


def script_of(word: str) -> str:
    at = int(np.searchsorted(_FIRST, ord(word[0]), side="right")) - 1
    return SCRIPTS[at][2] if at >= 0 and ord(word[0]) <= SCRIPTS[at][1] else "other"


def features(word: str) -> list[int]:
    """Hashed bigrams, trigrams and the word itself, with marks at both ends."""
    marked = f"^{word.lower()}$".encode("utf-8", "surrogatepass")
    n, crc, top = len(marked), zlib.crc32, BUCKETS - 1
    grams = [marked[i : i + 2] for i in range(n - 1)] + [marked[i : i + 3] for i in range(n - 2)]
    return [crc(g) & top for g in grams] + [crc(marked, 1) & top]


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages
    scripts: dict[str, np.ndarray]  # whether each language uses the script
    usual: int


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on rows with a language that are not held out."""
    rows = docs.where(~held_out(doc_id) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.xxhash64(F.col(doc_id)).alias("h"), F.col(text).alias("text"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), "f4"), {}, 0)
    at = {name: i for i, name in enumerate(languages)}
    span = 1 << 20
    limits = F.create_map(*(x for name in languages for x in (F.lit(name), F.lit(min(span, -(-sample_rows * span // counts[name]))))))
    sample = rows.where(F.pmod("h", F.lit(span)) < limits[F.col("lang")]).select("lang", "text")

    def make():
        sums: dict[tuple[str, int], int] = {}

        def each(name, body):
            for word, n in _counted(words_in(body).findall(body)).items():
                for f in features(word):
                    sums[name, f] = sums.get((name, f), 0) + n
                key = name, -1 - _SCRIPT_NAMES.index(script_of(word))
                sums[key] = sums.get(key, 0) + n
            return ()

        return each, lambda: [(name, f, n) for (name, f), n in sums.items()]

    got = by_rows(sample, make, "lang string, bucket bigint, n bigint", finish=True).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros((BUCKETS, len(languages)))
    used = {name: np.zeros(len(languages)) for name in _SCRIPT_NAMES}
    for name, bucket, n in zip(got["lang"], got["bucket"], got["n"]):
        if bucket >= 0:
            seen[bucket, at[name]] += n
        else:
            used[_SCRIPT_NAMES[-1 - bucket]][at[name]] += n
    share = {k: v / np.maximum(1.0, sum(used.values())) >= 0.01 for k, v in used.items()}
    weights = np.log((seen + 0.5) / (seen.sum(axis=0) + 0.5 * BUCKETS)).astype("f4")
    return Model(languages, weights, {k: v for k, v in share.items() if v.any()}, at[max(languages, key=lambda x: (counts[x], x))])


_SCRIPT_NAMES = [*dict.fromkeys(s[2] for s in SCRIPTS), "other"]


def _counted(words: list[str]) -> dict[str, int]:
    out: dict[str, int] = {}
    for w in words:
        out[w] = out.get(w, 0) + 1
    return out


class Labeller:
    def __init__(self, model: Model, penalty: float = SWITCH_PENALTY):
        self.model, self.penalty = model, penalty
        self.known: dict[str, int] = {}
        self.letters: dict[str, np.ndarray] = {}
        self.rows = np.zeros((1 << 16, len(model.languages)))

    def _learn(self, words: list[str]) -> None:
        """Scores of new words, all at once: relative to the best candidate, and at least the floor."""
        model, known, n = self.model, self.known, len(self.known)
        while n + len(words) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        grams = [features(w) for w in words]
        ends = np.cumsum([len(g) for g in grams])
        sums = np.add.reduceat(model.weights[list(chain.from_iterable(grams))].astype("f8"), np.concatenate([[0], ends[:-1]]), axis=0)
        can = np.array([self._candidates(w[0]) for w in words])
        best = np.where(can, sums, -np.inf).max(axis=1, keepdims=True)
        scores = np.where(can, np.maximum(sums - np.where(np.isfinite(best), best, 0.0), -FLOOR), -FLOOR)
        scores[~can.any(axis=1)] = 0.0  # a script that no language writes says nothing
        self.rows[n : n + len(words)] = scores
        known.update(zip(words, range(n, n + len(words))))

    def _candidates(self, letter: str) -> np.ndarray:
        found = self.letters.get(letter)
        if found is None:
            found = self.letters[letter] = self.model.scripts.get(script_of(letter), np.zeros(len(self.model.languages), dtype=bool))
        return found

    def path(self, scores: np.ndarray) -> np.ndarray:
        """Viterbi: the language of each word."""
        n, languages = scores.shape
        best = int(scores.sum(axis=0).argmax())
        gain = np.cumsum(scores - scores[:, best : best + 1], axis=0)
        low = np.minimum(np.minimum.accumulate(np.vstack([np.zeros((1, languages)), gain[:-1]])), 0.0)
        if (gain - low).max() < self.penalty:
            return np.full(n, best)
        value, came = [0.0] * languages, []
        for row in scores.tolist():
            top = max(value)
            k, cut = value.index(top), top - self.penalty
            came.append([j if v >= cut else k for j, v in enumerate(value)])
            value = [(v if v >= cut else cut) + s for v, s in zip(value, row)]
        out = np.empty(n, dtype=int)
        state = value.index(max(value))
        for i in range(n - 1, -1, -1):
            out[i] = state
            state = came[i][state]
        return out

    def __call__(self, text: str | None) -> tuple[str, float, list]:
        text = text or ""
        words = words_in(text).findall(text)
        if not words or not self.model.languages:
            return UNDETERMINED, 0.0, []
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known.get
        at = [known(w, -1) for w in words]
        if -1 in at:
            self._learn(list(dict.fromkeys(w for w, i in zip(words, at) if i < 0)))
            at = [known(w) for w in words]
        scores = self.rows[at]
        names = self.model.languages
        if not scores.any() and not any(self._candidates(w[0]).any() for w in words):
            return names[self.model.usual], 0.0, []
        path = self.path(scores)
        letters = np.bincount(path, weights=np.fromiter(map(len, words), dtype=float, count=len(words)), minlength=len(names))
        best = int(letters.argmax())
        return names[best], float(letters[best] / letters.sum()), self._spans(text, path)

    def _spans(self, text: str, path: np.ndarray) -> list[dict]:
        cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
        if len(cuts) == 2:
            return [{"start": 0, "end": len(text), "lang": self.model.languages[path[0]]}]
        starts = [m.start() for m in words_in(text).finditer(text)]
        edges = [0, *(starts[c] for c in cuts[1:-1]), len(text)]
        return [{"start": a, "end": b, "lang": self.model.languages[path[c]]} for a, b, c in zip(edges, edges[1:], cuts)]


def labeller(model: Model, penalty: float) -> Labeller:
    """One for each Python worker and model: the broadcast model stays in the worker, and its labeller with it."""
    have = getattr(model, "labeller", None)
    if have is None or have.penalty != penalty:
        have = model.labeller = Labeller(model, penalty)
    return have


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``PREDICTED`` for every row, from its text alone; the id is only carried. Spans cover the text, code points, end exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        label = labeller(shared.value, penalty)
        return lambda key, body: [(key, *label(body))]

    return by_rows(docs.select(F.col(doc_id).cast("bigint").alias("a"), F.col(text).alias("b")), make, PREDICTED)


def keep(docs: DataFrame, model: Model, least: float, text: str = "text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """The rows of ``docs``, all columns untouched, whose predicted language is determined and scores ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        label = labeller(shared.value, penalty)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                found = [label(t) for t in part.column(at).to_pylist()]
                yield part.filter(pa.array([f[0] != UNDETERMINED and f[1] >= least for f in found]))

    return docs.mapInArrow(run, docs.schema)
