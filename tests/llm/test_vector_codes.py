"""Vector codes in whole numbers against a plain version."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from codequarry.llm.vector_codes import nearest, sequency_order, transformed, vector_codes, whole_numbers

SCHEMA = "vec_id long, embedding array<double>, label string, code int"


def plain(rows, parts, entries, rounds, scale):
    """Codebooks, and by row its code and error, with Python's numbers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max(1, -(-max((len(r[1]) for r in kept), default=0) // parts))
    whole = [[math.floor(scale * x) if abs(x) < 2**53 else math.floor(x) * scale for x in r[1]] + [0] * (parts * width - len(r[1])) for r in kept]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    books, codes, errors = [], [""] * len(kept), [0] * len(kept)
    for p in range(parts):
        own = [w[p * width : (p + 1) * width] for w in whole]
        book = [list(x) for x in own[:entries]]
        for turn in range(rounds + 1):
            best = [min((far(x, e), k) for k, e in enumerate(book)) for x in own]
            if turn < rounds:
                for k in range(len(book)):
                    mine = [x for x, (_, b) in zip(own, best) if b == k]
                    if mine:
                        book[k] = [sum(c) // len(mine) for c in zip(*mine)]
        books.append(book)
        codes = [c + f"{b:02x}" for c, (_, b) in zip(codes, best)]
        errors = [e + d for e, (d, _) in zip(errors, best)]
    by_label = {}
    for r, e in zip(kept, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    fits = {k: all(e < 2**63 for r, e in zip(kept, errors) if r[2] == k) and v < 2**63 for k, v in by_label.items()}
    return books if kept else [], [(r[0], c, e if e < 2**63 else None, by_label[r[2]] if fits[r[2]] else None) for r, c, e in zip(kept, codes, errors)]


@pytest.mark.parametrize(("parts", "dim", "big"), [(8, 64, False), (4, 12, False), (3, 10, False), (2, 6, True)])
def test_codes_against_a_plain_version(spark, parts, dim, big):
    rnd = random.Random(dim)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(dim)], rnd.choice(["a", "a", "b", None]), 1) for i in range(3, 90)]
    rows += [(200 + i, [0.5] * dim, "hot", 1) for i in range(60)] + [(2, [rnd.choice([-0.25, 0.0, 0.25]) for _ in range(dim)], "b", 1)]
    rows += [(400, None, "a", 1), (401, [float("nan")] * dim, "a", 1), (402, [None] * dim, "a", 1), (0, [math.inf] + [0.0] * (dim - 1), "a", 1),
             (403, [1.0, -1.0], "short", 1), (404, [], "empty", 1), (None, [0.1] * dim, "a", 1), (5, [0.2] * dim, "a", 1)]
    if big:
        rows += [(500, [1e30] * dim, "big", 1), (501, [-3e15, 5e8] + [1.0] * (dim - 2), "b", 1)]
    got, books = vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(3), parts, 16, 4)
    want_books, want = plain(rows, parts, 16, 4, 4096)
    assert books == want_books
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_few_vectors_and_none(spark):
    rows = [(7, [0.5, 1.0], "a", 1), (9, [0.5, 1.0], None, 1)]
    got, books = vector_codes(spark.createDataFrame(rows, SCHEMA), 2)
    assert books == [[[2048], [2048]], [[4096], [4096]]]
    assert sorted(map(tuple, got.collect()), key=str) == [(7, "0000", 0, 0), (9, "0000", 0, 0)]
    got, books = vector_codes(spark.createDataFrame([], SCHEMA))
    assert books == [] and got.count() == 0
    with pytest.raises(ValueError):
        vector_codes(spark.createDataFrame([], SCHEMA), scale=1000)


def test_transform_keeps_scaled_distances():
    rnd = np.random.default_rng(1)
    for width in (1, 3, 8, 11):
        x, c = rnd.integers(-5000, 5000, (40, width)), rnd.integers(-5000, 5000, (9, width))
        c[4] = c[2]
        size = transformed(x).shape[1]
        far = ((x[:, None] - c) ** 2).sum(axis=2)
        assert (((transformed(x)[:, None] - transformed(c)) ** 2).sum(axis=2) == size * far).all()
        index, least = nearest(x, c)
        assert (index == far.argmin(axis=1)).all() and (least == far.min(axis=1)).all()
        index, least = nearest(x.astype(object), c.astype(object))
        assert (index == far.argmin(axis=1)).all() and (least == far.min(axis=1)).all()


def test_sequency_and_floors():
    signs = [[(-1) ** (i & j).bit_count() for j in range(8)] for i in sequency_order(8)]
    assert [sum(a != b for a, b in zip(r, r[1:])) for r in signs] == list(range(8))
    assert whole_numbers(np.array([-0.0001, 0.0, 0.9999, -1.0]), 4096).tolist() == [-1, 0, 4095, -4096]
