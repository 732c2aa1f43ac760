"""Vector codes: adaptive bounds against rounds of full comparisons in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from casewright.llm import codes, queries

SCHEMA = "vec_id bigint, embedding array<double>, label string, state string, error int"


def brute(rows, rounds=4):
    """{i: (vec_id, code, error, label_error, digest)} of usable rows, by full comparisons."""
    kept = [(k, [max(-(1 << 63), min((1 << 63) - 1, math.floor(x * 1024))) for x in v], label) for k, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    dims = -(-max(1, *(len(v) for _, v, _ in kept)) // 4) * 4
    m = dims // 4
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    parts = [[(v + [0] * (dims - len(v)))[p * m : (p + 1) * m] for p in range(4)] for _, v, _ in kept]
    books = [[x[p] for x in parts[:256]] for p in range(4)]

    def assigned():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[p], e)), k) for k, e in enumerate(books[p])) for p in range(4)] for x in parts]

    for _ in range(rounds):
        near = assigned()
        for p in range(4):
            mine = [[] for _ in books[p]]
            for x, a in zip(parts, near):
                mine[a[p][1]].append(x[p])
            books[p] = [[sum(c) // len(got) for c in zip(*got)] if got else old for got, old in zip(mine, books[p])]
    near = assigned()
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    errors = [min(sum(d for d, _ in a), (1 << 63) - 1) for a in near]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = min(by_label.get(label, 0) + e, (1 << 63) - 1)
    return sorted(
        ((k, "".join(f"{e:02x}" for _, e in a), d, by_label[label], digest) for (k, _, label), a, d in zip(kept, near, errors)), key=str
    )


def coded(spark, rows, **more):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    got = queries.with_label_error(codes.compress(df, **more))
    return sorted(map(tuple, got.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def clustered(n, dims, seed=1):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(12)]
    return [(i * 3 % n, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)], rng.choice(["a", "b", None])) for i in range(n)]


def test_against_full_comparisons(spark):
    lengths = []
    rows = clustered(1000, 8)
    assert coded(spark, rows, watch=lengths.append) == brute(rows)
    assert lengths[0] == [32] * 4 and max(lengths[-1]) < 32  # lists get shorter


def test_ties_and_repeats(spark):
    rng = random.Random(5)
    # few distinct values: most distances are ties, entries repeat
    rows = [(rng.randrange(150), [rng.choice([0.0, 0.25, -0.001]) for _ in range(8)], "x") for _ in range(700)]
    assert coded(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (None, [0.5, 0.25, 0.125, 1.0, 2.0], None), (None, [0.5], "a"), (3, None, "a"), (4, [], "a"), (5, [nan, 0.0], "a"), (6, [inf, 1.0], "a"),
        (7, [None, 1.0], None), (8, [-0.0, -1e-9, 1e-9, -0.0009], None), (8, [-0.0, -1e-9, 1e-9, -0.0009], None), (8, [3.0] * 7, "b"),
    ]
    assert coded(spark, rows) == brute(rows)
    assert coded(spark, rows[2:3]) == [] and coded(spark, []) == []


def test_values_beyond_53_bits(spark):
    rows = clustered(300, 4) + [(1000 + k, [1e6 * k, -1e5 * k, 3.0, 0.1], "wide") for k in range(40)] + [(2000, [1e300, -1e300, 0.0, 0.0], "wide")]
    assert coded(spark, rows) == brute(rows)


@pytest.mark.parametrize("wide", [False, True])
def test_lists_hold_what_they_promise(wide):
    rng = np.random.default_rng(3)
    x = rng.integers(-300, 300, (500, 3))
    kind = (1 << 40) if wide else 300
    entries = rng.integers(-300, 300, (60, 3))
    book = codes.Book(entries.tolist(), None, kind)
    assert book.kind is (object if wide else np.float64)
    lists, _ = codes.nearest(book, x.astype(book.kind), 9)
    for step in range(4):
        moved = entries + rng.integers(-15, 16, entries.shape)
        book = codes.Book(moved.tolist(), entries.tolist(), kind)
        entries = moved
        had = lists.ids.shape[1]
        lists = codes.Lists.unpacked(lists.packed(), had, max(had - step, 4))
        lists, least = codes.again(book, x.astype(book.kind), lists)
        d = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (lists.ids[:, 0] == d.argmin(axis=1)).all() and (least.astype(int) == d.min(axis=1)).all()
        listed = np.take_along_axis(d, lists.ids, axis=1)
        assert (lists.bounds <= np.sqrt(listed)).all()
        rest = d.copy()
        np.put_along_axis(rest, lists.ids, 1 << 40, axis=1)
        assert (lists.outer <= np.sqrt(rest.min(axis=1))).all()
    assert (lists.needed < 10).any()
