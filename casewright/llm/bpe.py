"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word's symbols sit in the leaves of a segment tree that holds, for each symbol, the rank of the pair it forms with
the next one. The root yields the lowest rank, the leftmost of equals; the pair is merged, its two neighbours' ranks
are updated along two paths to the root, and so on until no pair can merge. That is O(n log n) for a word of any
length. Equal words are encoded once in a task, behind a bounded store.

Words, lower case and white space follow the tokenizer file's normaliser and pre-tokenizer. Texts of plain Latin
characters are split here; any other text passes through the library's own normaliser and pre-tokenizer, whose
Unicode tables decide. Merging is always done here.

Defined results: a null text is an empty one, with no ids and an empty decoded text; special tokens in a text become
their ids, as in the library; repeated rows give repeated results; an empty table gives an empty one; columns other
than the id and the text are not read.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import chain

from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from casewright.llm.packing import _byte_letters
from casewright.llm.shared import by_rows

ENCODED = "doc_id bigint, ids array<int>, decoded string"
#: Words whose encoding a task remembers; past that it starts anew.
REMEMBERED = 400_000
_NONE = 1 << 62

# Characters on which all regex engines and case tables agree; superscripts, fractions and the dotted I are left out.
PLAIN = re.compile("[^\\t\\n\\r\\x20-\\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ɏ‐-―‘-‟•…€]")
WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    return {b: c for c, b in _byte_letters().items()}


class RankTree:
    """Segment tree of pair ranks. ``best[1]``, the root, is the lowest rank."""

    def __init__(self, ranks: list[int]):
        self.size = size = 1 << max(0, (len(ranks) - 1).bit_length())
        self.best = best = [_NONE] * size + ranks + [_NONE] * (size - len(ranks))
        for i in range(size - 1, 0, -1):
            left, right = best[2 * i], best[2 * i + 1]
            best[i] = left if left <= right else right

    def update(self, at: int, rank: int) -> None:
        best, i = self.best, at + self.size
        if best[i] == rank:
            return
        best[i] = rank
        while i > 1:
            other = best[i ^ 1]
            lower = best[i]
            if other < lower:
                lower = other
            i >>= 1
            if best[i] == lower:
                return
            best[i] = lower

    def leftmost(self) -> int:
        """Position of the root's rank; the left child wins a tie."""
        best, size, i = self.best, self.size, 1
        rank = best[1]
        while i < size:
            i *= 2
            if best[i] != rank:
                i += 1
        return i - size


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        # (left id, right id) -> (rank, merged id)
        self.merges = {(self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in enumerate(model["merges"])}
        self.letter = byte_letters()
        self.library = Tokenizer.from_file(path)
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words: dict[str, tuple[tuple[int, ...], str]] = {}

    def merged(self, letters: str) -> list[int]:
        """Ids of one word, given in the vocabulary's byte letters."""
        symbols = [self.vocab[c] for c in letters[:-1]]
        symbols.append(self.vocab[letters[-1] + self.suffix])
        n = len(symbols)
        pair, none = self.merges.get, (_NONE, -1)
        tree = RankTree([pair(p, none)[0] for p in zip(symbols, symbols[1:])])
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while tree.best[1] != _NONE:
            i = tree.leftmost()
            j = after[i]
            k = after[j]
            symbols[i] = self.merges[symbols[i], symbols[j]][1]
            symbols[j] = -1
            after[i] = k
            if k < n:
                before[k] = i
                tree.update(j, _NONE)
                tree.update(i, pair((symbols[i], symbols[k]), none)[0])
            else:
                tree.update(i, _NONE)
            h = before[i]
            if h >= 0:
                tree.update(h, pair((symbols[h], symbols[i]), none)[0])
        return [s for s in symbols if s >= 0]

    def _word(self, word: str) -> tuple[tuple[int, ...], str]:
        ids = tuple(self.merged(word if word.isascii() else "".join([self.letter[b] for b in word.encode()])))
        if len(self.words) >= REMEMBERED:
            self.words.clear()
        got = self.words[word] = (ids, " ".join(self.tokens[i] for i in ids))
        return got

    def _plain(self, text: str) -> list[tuple[tuple[int, ...], str]]:
        known, new = self.words, self._word
        return [known.get(w) or new(w) for w in WORDS.findall(text.lower())]

    def _any(self, text: str) -> list[tuple[tuple[int, ...], str]]:
        if not PLAIN.search(text):
            return self._plain(text)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [(tuple(ids), " ".join(self.tokens[i] for i in ids)) for ids in (self.merged(letters) for letters, _ in pieces)]

    def encode(self, text: str) -> tuple[list[int], str]:
        """Ids, and their decoded text: the file has no decoder, so tokens are joined by one space."""
        found: list[tuple[tuple[int, ...], str]] = []
        if self.parts and "<|" in text:
            for k, part in enumerate(self.parts.split(text)):
                found += [((self.special[part],), part)] if k % 2 else self._any(part)
        else:
            found = self._any(text)
        return list(chain.from_iterable(f[0] for f in found)), " ".join(f[1] for f in found)


@lru_cache(maxsize=2)
def loaded(path: str) -> Bpe:
    """One for each Python worker, which runs many tasks."""
    return Bpe(path)


def encode(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``ENCODED`` for every row."""
    columns = docs.select(F.col(doc_id).cast("bigint").alias("a"), F.coalesce(F.col(text), F.lit("")).alias("b"))

    def make():
        bpe = loaded(tokenizer)
        return lambda key, body: [(key, *bpe.encode(body))]

    return by_rows(columns, make, ENCODED)
