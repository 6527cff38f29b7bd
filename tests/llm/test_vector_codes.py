import math
from collections import defaultdict

import numpy as np
import pytest

from lendloom.llm.vector_codes import PARTS, choose_pivots, codebook_digest, compress, nearest, pivot_distances, squared, with_label_error


def plain(rows, entries, rounds, parts=PARTS):
    """Codes, errors and codebooks in plain Python integers."""
    kept = [(i, [math.floor(256 * x) for x in v], la) for i, v, la in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0], r[1]))
    d = len(kept[0][1]) // parts
    cut = [[v[p * d:(p + 1) * d] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            groups = defaultdict(list)
            for c, f in zip(cut, found):
                groups[f[p][1]].append(c[p])
            for k, members in groups.items():
                books[p][k] = [sum(x) // len(members) for x in zip(*members)]
    errors = defaultdict(int)
    final = assign()
    for (_, _, la), f in zip(kept, final):
        errors[la] += sum(e for e, _ in f)
    return [(i, "".join(f"{k:02x}" for _, k in f), sum(e for e, _ in f), errors[la]) for (i, _, la), f in zip(kept, final)], books


def vectors(n, size, seed=1):
    random = np.random.default_rng(seed)
    rows = [(i, (random.normal(size=size) * 0.3).round(3).tolist(), None if i % 7 == 0 else i % 3) for i in range(n)]
    rows += [(n, None, 1), (n + 1, [None] * size, 1), (n + 2, [float("nan")] * size, 1), (n + 3, [float("inf")] + [0.0] * (size - 1), 2)]
    rows += [(n + 4, rows[0][1], 5), (n + 4, rows[1][1], 5), (n + 5, [0.0] * size, 5), (n + 6, [-0.001] * size, 5)]
    return rows


@pytest.mark.parametrize("n, size, entries", [(150, 32, 64), (20, 16, 64), (300, 48, 9)])
def test_against_plain_python(spark, n, size, entries):
    rows = vectors(n, size)
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "vec_id long, embedding array<double>, label int, code double").repartition(5)
    codes, books = compress(df, label="label", entries=entries)
    expected, plain_books = plain(rows, entries, 2)
    assert sorted(tuple(r) for r in with_label_error(codes, "label").select("vec_id", "code", "error", "label_error").collect()) == sorted(expected)
    assert books.tolist() == plain_books and len(codebook_digest(books)) == 64


def test_bounds_prune_and_never_lose(spark):
    random = np.random.default_rng(5)
    parts, book = random.integers(-200, 200, (500, 6)), random.integers(-200, 200, (64, 6))
    book[40] = book[3]  # a tie goes to the lower index
    pivots = choose_pivots(book)
    who, best, evaluated = nearest(parts, pivot_distances(parts, pivots), book, pivots)
    every = squared(parts[:, None], book[None])
    assert (who == every.argmin(1)).all() and (best == every.min(1)).all() and evaluated < 0.7 * every.size
    same = nearest(book, pivot_distances(book, pivots), book, pivots)
    assert (same[1] == 0).all() and same[0][40] == 3


def test_nothing_to_keep_and_odd_lengths(spark):
    none = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")
    codes, books = compress(none, label="label")
    assert books is None and codes.columns == ["vec_id", "code", "error", "label"] and with_label_error(codes, "label").count() == 0
    odd = spark.createDataFrame([(1, [0.5] * 16), (2, [0.5] * 32), (3, [0.5] * 15), (4, [])], "vec_id long, embedding array<float>")
    assert [r["vec_id"] for r in compress(odd)[0].collect()] == [1]
    with pytest.raises(Exception, match="component"):
        compress(spark.createDataFrame([(1, [1e9] * 16)], "vec_id long, embedding array<double>"))
