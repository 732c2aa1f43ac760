"""Product codes of vectors: four integer codebooks, learned by rounds of nearest entries with adaptive distance bounds.

Components become integers, ``floor(1024 * x)``; a vector is cut into four parts, and each part position has a codebook.
An assignment keeps with each row, and for each part, its b closest entries, nearest first, with a lower bound of the
distance to each, and one outer bound for all other entries (Drake and Hamerly). When the entries have moved, a bound
falls by its entry's move and the outer one by the largest. The distance to the old nearest entry is computed exactly; the
entries whose bounds lie above it cannot be nearest. Those before are the uncertain ones: their distances are computed in
integers, and ties go to the lower index. Only where not even the outer bound lies above it are all entries computed.
How many entries a row needed is counted, and b becomes the least that is enough for all but ``BEYOND`` of the rows.

The state of a round is a written table, one row a vector, so a lost executor costs a part of one round. Sums of parts are
made in each task, then grouped; the driver sees codebooks and counts, never rows.

Arithmetic is exact: in doubles while every sum of squares fits 53 bits, beyond that in Python integers. Defined results: a
vector that is null or holds a null or non-finite component is dropped; a shorter vector is filled up with zeros to the
longest one's length, rounded up to a multiple of four; integers saturate at 64 bits, as does an error; null ids come
last; rows of one id are rows of their own, in the order of their vectors; with fewer than 256 vectors the codebook has
one entry for each; an empty table gives an empty one; other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casewright.llm.shared import cut_lineage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Entries that a row's list starts with, the fewest it may get, and the share of rows that may need more.
FIRST_B, LEAST_B, BEYOND = 32, 4, 0.01
#: Rows whose distances to all entries are held at once.
ROWS_TOGETHER = 1024
_LIMIT = (1 << 63) - 1

Codebooks = list[list[list[int]]]  # part, entry, position


def usable(vector: Column) -> Column:
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, sound), F.lit(False))


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))


# Arithmetic ---------------------------------------------------------------------------------------


class Book:
    """One part's codebook, and how far its entries moved from the one before."""

    def __init__(self, entries: list[list[int]], before: list[list[int]] | None, largest: int):
        size = max([largest, *(abs(v) for e in entries for v in e)])
        self.kind = np.float64 if len(entries[0]) * 4 * size * size < 1 << 53 else object
        self.entries = np.array(entries, dtype=self.kind)
        self.norms = (self.entries * self.entries).sum(axis=1)
        self.moves = np.zeros(len(entries))
        if before:
            gone = [sum((a - b) ** 2 for a, b in zip(x, y)) for x, y in zip(entries, before)]
            self.moves = np.sqrt(np.array(gone, dtype=object).astype(float)) * (1 + 1e-9)

    def all(self, x: np.ndarray) -> np.ndarray:
        """Squared distances of all rows to all entries."""
        return (x * x).sum(axis=1)[:, None] + self.norms[None, :] - 2 * (x @ self.entries.T)

    def of(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        gap = x - self.entries[entry]
        return (gap * gap).sum(axis=1)


def _below(squared: np.ndarray) -> np.ndarray:
    """Lower bounds of distances that hold in single precision."""
    return (np.sqrt(squared.astype(float)) * (1 - 1e-6)).astype(np.float32)


class Lists:
    """Closest entries ``ids (n, b)``, nearest first, their lower bounds, the outer bound, and how many entries were needed."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray, outer: np.ndarray, needed: np.ndarray):
        self.ids, self.bounds, self.outer, self.needed = ids, bounds, outer, needed

    def packed(self) -> np.ndarray:
        parts = self.ids.astype(np.uint8), self.bounds.astype("<f4").view(np.uint8), self.outer.astype("<f4")[:, None].view(np.uint8), self.needed.astype(np.uint8)[:, None]
        return np.concatenate([p.reshape(len(self.ids), -1) for p in parts], axis=1)

    @staticmethod
    def width(b: int) -> int:
        return 5 * b + 5

    @classmethod
    def unpacked(cls, raw: np.ndarray, b: int, keep: int) -> Lists:
        """The first ``keep`` of ``b`` entries; the outer bound then covers the others."""
        bounds = np.ascontiguousarray(raw[:, b : 5 * b]).view("<f4").reshape(len(raw), b)
        outer = np.ascontiguousarray(raw[:, 5 * b : 5 * b + 4]).view("<f4")[:, 0]
        if keep < b:
            outer = np.minimum(outer, bounds[:, keep:].min(axis=1))
        return cls(raw[:, :keep].astype(np.int64), bounds[:, :keep].astype(np.float64), outer.astype(np.float64), raw[:, -1])


def nearest(book: Book, x: np.ndarray, b: int) -> tuple[Lists, np.ndarray]:
    """Lists from the distances to all entries, and the least distances."""
    n, k = len(x), len(book.entries)
    b = min(b, k)
    ids, bounds, outer, least = np.empty((n, b), dtype=np.int64), np.empty((n, b), dtype=np.float32), np.full(n, np.inf, dtype=np.float32), np.empty(n, dtype=book.kind)
    for at in range(0, n, ROWS_TOGETHER):
        rows = slice(at, at + ROWS_TOGETHER)
        d = book.all(x[rows])
        order = np.argsort(d, axis=1, kind="stable")  # a tie keeps the lower index first
        sorted_d = np.take_along_axis(d, order[:, : b + 1], axis=1)
        ids[rows], bounds[rows], least[rows] = order[:, :b], _below(sorted_d[:, :b]), sorted_d[:, 0]
        if k > b:
            outer[rows] = _below(sorted_d[:, b])
    return Lists(ids, bounds, outer, np.full(n, 255)), least


def again(book: Book, x: np.ndarray, was: Lists) -> tuple[Lists, np.ndarray]:
    """Lists after the entries moved, and the least distances."""
    n, b = was.ids.shape
    ids, bounds, outer = was.ids, was.bounds - book.moves[was.ids], was.outer - book.moves.max()
    least = book.of(x, ids[:, 0])
    reach = np.sqrt(least.astype(float)) * (1 + 1e-9)
    # place z: everything from z on is at least that far
    from_here = np.minimum.accumulate(np.concatenate([bounds, outer[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1]
    certain = reach[:, None] < from_here[:, 1:]
    needed = np.where(certain.any(axis=1), certain.argmax(axis=1) + 1, b + 1)
    bounds = bounds.astype(np.float64)
    bounds[:, 0] = _below(least)
    row, place = np.nonzero((np.arange(b)[None, :] < needed[:, None]) & (needed <= b)[:, None] & (np.arange(b) > 0)[None, :])
    if len(row):
        entry = ids[row, place]
        d = book.of(x[row], entry)
        bounds[row, place] = _below(d)
        winner = ids[:, 0].copy()
        at = np.lexsort((entry, d, row)) if book.kind is not object else np.array(sorted(range(len(row)), key=lambda i: (row[i], d[i], entry[i])))
        head = at[np.flatnonzero(np.diff(row[at], prepend=-1))]  # each row's best candidate
        r, best, e = row[head], d[head], entry[head]
        better = (best < least[r]) | ((best == least[r]) & (e < winner[r]))
        winner[r[better]], least[r[better]] = e[better], best[better]
        changed = np.flatnonzero(needed <= b)
        key = np.where(ids[changed] == winner[changed, None], -np.inf, bounds[changed])
        order = np.argsort(key, axis=1, kind="stable")
        ids, bounds = ids.copy(), bounds
        ids[changed], bounds[changed] = np.take_along_axis(ids[changed], order, axis=1), np.take_along_axis(bounds[changed], order, axis=1)
    far = np.flatnonzero(needed > b)
    if len(far):
        fresh, d = nearest(book, x[far], b)
        ids = ids.copy()
        ids[far], bounds[far], outer[far], least[far] = fresh.ids, fresh.bounds, fresh.outer, d
    return Lists(ids, np.minimum(bounds, 3e38), np.minimum(outer, np.float32(np.inf)), np.minimum(needed, 254)), least


# Tables -------------------------------------------------------------------------------------------


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of integers, filled up with zeros: (n, PARTS, positions)."""
    n, values = len(column), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy()) if n else np.zeros(0, dtype=int)
    if n and (sizes == dims).all():
        return values.reshape(n, PARTS, -1)
    out = np.zeros((n, dims), dtype=np.int64)
    out[np.repeat(np.arange(n), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out.reshape(n, PARTS, -1)


def _bytes_of(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    offsets = np.arange(0, (n + 1) * width, width, dtype=np.int32) if width else np.zeros(n + 1, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(matrix).tobytes())])


def _rows_of(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), width)


def assign(rows: DataFrame, books: Codebooks, dims: int, largest: int, before: Codebooks | None = None, had: list[int] | None = None, b: list[int] | None = None) -> DataFrame:
    """``rows`` (key, vector, label and, if ``before`` is given, state) with the new ``state`` and the ``error``."""
    keep = b or [min(FIRST_B, len(books[0]))] * PARTS

    def run(batches):
        made = [Book(books[p], before[p] if before else None, largest) for p in range(PARTS)]
        for batch in batches:
            if not batch.num_rows:
                continue
            x, packed, error = _matrix(batch.column(1), dims), [], 0
            raw = _rows_of(batch.column(3), sum(map(Lists.width, had))) if before else None
            at = 0
            for p, book in enumerate(made):
                part = x[:, p].astype(book.kind)
                if before:
                    lists, least = again(book, part, Lists.unpacked(raw[:, at : at + Lists.width(had[p])], had[p], keep[p]))
                    at += Lists.width(had[p])
                else:
                    lists, least = nearest(book, part, keep[p])
                packed.append(lists.packed())
                error = error + least.astype(object if least.dtype == object else np.int64)
            total = pa.array([min(int(e), _LIMIT) for e in error.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), _bytes_of(np.concatenate(packed, axis=1)), total], names=["key", "vector", "label", "state", "error"])

    columns = ["key", "vector", "label"] + (["state"] if before else [])
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select(*columns).mapInArrow(run, f"key {kinds['key']}, vector array<bigint>, label {kinds['label']}, state binary, error bigint")


def totals(state: DataFrame, dims: int, b: list[int]) -> tuple[dict, list[list[int]]]:
    """{(part, entry): (rows, sums by position)}, and for each part how many rows needed how many entries."""
    starts = np.cumsum([0, *map(Lists.width, b)]).tolist()
    m = dims // PARTS

    def run(batches):
        counts, sums = np.zeros((PARTS, 512), dtype=np.int64), np.zeros((PARTS, ENTRIES, m), dtype=object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, raw = _matrix(batch.column(0), dims), _rows_of(batch.column(1), starts[-1])
            wide = max(x.max(initial=0), -1 - x.min(initial=0)) >= 1 << 40
            for p in range(PARTS):
                entry = raw[:, starts[p]].astype(np.int64)
                counts[p] += np.bincount(entry, minlength=512) + np.bincount(raw[:, starts[p + 1] - 1].astype(np.int64) + ENTRIES, minlength=512)
                at = np.argsort(entry, kind="stable")
                heads = np.flatnonzero(np.diff(entry[at], prepend=-1))
                part = x[at, p].astype(object) if wide else x[at, p]
                sums[p, entry[at][heads]] += np.add.reduceat(part, heads, axis=0).astype(object)
        told = [(p, e) for p in range(PARTS) for e in np.flatnonzero(counts[p]).tolist()]
        if told:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p for p, _ in told], pa.int32()), pa.array([e for _, e in told], pa.int32()), pa.array([int(counts[p, e]) for p, e in told], pa.int64()),
                    pa.array([[Decimal(int(v)) for v in sums[p, e]] if e < ENTRIES else [Decimal(0)] * m for p, e in told], pa.list_(pa.decimal128(38, 0))),
                ],
                names=["part", "entry", "n", "sums"],
            )

    made = state.select("vector", "state").mapInArrow(run, "part int, entry int, n bigint, sums array<decimal(38,0)>")
    grouped = made.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(m)])
    found, needed = {}, [[0] * 256 for _ in range(PARTS)]
    for row in grouped.collect():  # at most 512 rows for each part
        if row["entry"] < ENTRIES:
            found[row["part"], row["entry"]] = row["n"], [int(row[f"s{i}"]) for i in range(m)]
        else:
            needed[row["part"]][row["entry"] - ENTRIES] = row["n"]
    return found, needed


def moved(books: Codebooks, found: dict) -> Codebooks:
    """Entries replaced by the floors of their parts' means; an unused entry stays."""
    new = []
    for p, book in enumerate(books):
        new.append([[s // found[p, e][0] for s in found[p, e][1]] if (p, e) in found else entry for e, entry in enumerate(book)])
    return new


def adapted(needed: list[int], had: int) -> int:
    """The least b, of at most ``had``, that all but ``BEYOND`` of the rows can do with."""
    if needed[255]:  # first lists: nothing is known yet
        return had
    left, total = sum(needed), sum(needed)
    for z, n in enumerate(needed[: had + 1]):
        left -= n
        if left <= BEYOND * total:
            return min(had, max(z, LEAST_B))
    return had


def digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS, entries: int = ENTRIES, watch: Callable[[list[int]], None] | None = None) -> DataFrame:
    """``key``, the columns ``codes`` (one entry number a part), ``error`` and ``label``, and the digest of the codebooks.

    ``watch`` is told the list lengths of every round.
    """
    kept = vectors.where(usable(F.col(vector))).select(F.col(key).alias("key"), integers(F.col(vector)).alias("vector"), F.col(label).alias("label"))
    ends = F.max(F.coalesce(F.array_max("vector"), F.lit(0))), F.min(F.coalesce(F.array_min("vector"), F.lit(0)))
    seen = kept.agg(F.max(F.size("vector")).alias("size"), ends[0].alias("largest"), ends[1].alias("lowest")).first()
    codes = lambda b: F.array(*[F.conv(F.hex(F.substring("state", 1 + at, 1)), 16, 10).cast("int") for at in np.cumsum([0, *map(Lists.width, b[:-1])]).tolist()])
    if seen["size"] is None:
        return kept.select("key", F.lit(None).cast("array<int>").alias("codes"), F.lit(0).cast("bigint").alias("error"), "label", F.lit("").alias("codebooks_sha256")).where("false")
    dims = -(-max(seen["size"], 1) // PARTS) * PARTS
    size = max(abs(seen["largest"]), abs(seen["lowest"]))
    first = kept.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).collect()  # one codebook's rows
    whole = [[*r["vector"], *[0] * (dims - len(r["vector"]))] for r in first]
    m = dims // PARTS
    books = [[v[p * m : (p + 1) * m] for v in whole] for p in range(PARTS)]
    had = [min(FIRST_B, len(whole))] * PARTS
    state = cut_lineage(assign(kept, books, dims, size))
    for _ in range(rounds):
        found, needed = totals(state, dims, had)
        new, b = moved(books, found), [adapted(needed[p], had[p]) for p in range(PARTS)]
        if watch:
            watch(b)
        state = cut_lineage(assign(state, new, dims, size, before=books, had=had, b=b))
        books, had = new, b
    return state.select("key", codes(had).alias("codes"), "error", "label", F.lit(digest(books)).alias("codebooks_sha256"))
