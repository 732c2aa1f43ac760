"""Vector bin packing of tokenised examples.

An example demands tokens, one segment, and loss-bearing tokens; a sequence has a limit on each. The dot-product
heuristic places, into the open sequence, the waiting example whose demand has the largest dot product with what is
left of the limits. When none fits whole, the one with the largest product is cut to fill the rest: cutting is free,
so a sequence ends short only if its segments or its loss-bearing tokens run out first.

A task packs the rows of its own partition, holding at most ``WAITING`` examples, so nothing is shuffled and memory
is bounded. What is left at a partition's end, less than one sequence, goes into sequences whose lengths are powers
of two, which need no padding. Sequence ids are made of the partition and a count, so a task run again gives the
same ids for the same rows.

Defined results: a null text is an empty one, which still has the closing id 0; repeated rows are packed once each;
an empty table gives an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from casewright.llm.shared import by_rows

SEQUENCE_TOKENS = 1024
SEQUENCE_SEGMENTS = 256
#: Examples that a task holds before it packs them.
WAITING = 256
CLOSING_ID = 0

PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"

# Characters on which all regex engines agree about letters, digits and white space.
_PLAIN = re.compile("[^\\t\\n\\r\\x20-\\x7e\xa1-ɏ‐-―‘-‟•…€]")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Ids of a byte-level BPE tokenizer file, equal to the tokenizers library's with add_special_tokens=False.

    Plain texts go through the same vocabulary and merges in tiktoken, which is several times as fast; any other text
    goes through the tokenizers library itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.exact = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec["added_tokens"]]
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self.fast = tiktoken.Encoding("bytes", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        # a very long stretch without a space is left to the library, whose merges do not slow down with it
        if _PLAIN.search(text) or any(s in text for s in self.special) or re.search(r"\S{2000}|\s{2000}", text):
            ids = self.exact.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.append(np.asarray(ids, dtype="<u4"), np.uint32(CLOSING_ID)).astype("<u4")


@lru_cache(maxsize=2)
def loaded(path: str) -> Encoder:
    """One for each Python worker, which runs many tasks."""
    return Encoder(path)


def _byte_letters() -> dict[str, int]:
    """The byte for each letter of a byte-level vocabulary: printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Packer:
    """Packs waiting examples into sequences; ``ids`` bear loss in [loss_from, len(ids) - 1), the closing id bears none."""

    def __init__(self, base: int, tokens: int, segments: int, loss: int, waiting: int = WAITING):
        self.limit, self.waiting = np.array([tokens, segments, loss], dtype=float), waiting
        self.next, self.items = base, []
        self.demand = np.zeros((0, 3))

    def add(self, doc_id, ids: np.ndarray, loss_from: int) -> Iterator[tuple]:
        self.items.append([doc_id, 0, len(ids), ids, loss_from])
        if len(self.items) >= self.waiting:
            yield from self.pack(self.waiting // 2)

    def _loss(self, item, start: int, end: int) -> int:
        return max(0, min(end, len(item[3]) - 1) - max(start, item[4]))

    def _cut(self, item, room: np.ndarray) -> int:
        """Length of the longest piece from the item's start that fits."""
        start, end = item[1], int(min(item[2], item[1] + room[0]))
        if self._loss(item, start, end) > room[2]:
            end = int(max(start, item[4]) + room[2])
        return end - start

    def fill(self, size: int) -> Iterator[tuple]:
        """One sequence of at most ``size`` tokens."""
        room, offset = self.limit.copy(), 0
        room[0] = size
        while self.items and room[0] >= 1 and room[1] >= 1:
            products = self.demand @ (room / self.limit**2)
            fits = (self.demand <= room).all(axis=1)
            k = int(np.argmax(np.where(fits, products, -1.0))) if fits.any() else int(np.argmax(products))
            item = self.items[k]
            n = self._cut(item, room)
            if n <= 0:
                break
            start, end = item[1], item[1] + n
            yield item[0], start, n, item[3][start:end].tobytes(), len(item[3]), self.next, offset
            room -= (n, 1, self._loss(item, start, end))
            offset += n
            item[1] = end
            if end == item[2]:
                last = self.items.pop()
                if k < len(self.items):
                    self.items[k] = last
                    self.demand[k] = self.demand[-1]
                self.demand = self.demand[:-1]
            else:
                self.demand[k] = (item[2] - end, 1, self._loss(item, end, item[2]))
        self.next += 1

    def pack(self, leave: int) -> Iterator[tuple]:
        """Whole sequences until at most ``leave`` examples wait, or less than a sequence of tokens does."""
        self.demand = np.array([[i[2] - i[1], 1, self._loss(i, i[1], i[2])] for i in self.items], dtype=float).reshape(-1, 3)
        while len(self.items) > leave and self.demand[:, 0].sum() >= self.limit[0]:
            yield from self.fill(int(self.limit[0]))

    def finish(self) -> Iterator[tuple]:
        yield from self.pack(0)
        while self.items:
            left = int(self.demand[:, 0].sum())
            yield from self.fill(min(int(self.limit[0]), 1 << (left.bit_length() - 1)))


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", tokens: int = SEQUENCE_TOKENS, segments: int = SEQUENCE_SEGMENTS, loss_tokens: int | None = None, loss_from: str | None = None) -> DataFrame:
    """Pieces (``PIECES``) of all rows; ``ids`` are little-endian unsigned 32-bit token ids.

    ``loss_from`` names a column with the count of a row's leading ids that bear no loss (a prompt); without it all
    ids but the closing one bear loss. ``loss_tokens`` defaults to ``tokens``.
    """
    prompt = F.coalesce(F.col(loss_from), F.lit(0)) if loss_from else F.lit(0)
    columns = docs.select(F.col(doc_id).cast("bigint").alias("a"), F.coalesce(F.col(text), F.lit("")).alias("b"), prompt.cast("bigint").alias("c"))

    def make():
        encode = loaded(tokenizer)
        packer = Packer(TaskContext.get().partitionId() << 40, tokens, segments, loss_tokens or tokens)
        return (lambda key, body, start: packer.add(key, encode(body), start)), packer.finish

    return by_rows(columns, make, PIECES, finish=True)
