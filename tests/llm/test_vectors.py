import hashlib
import math

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from trendlens.llm import vectors

from .conftest import SMALL


def brute(rows, parts, entries, rounds):
    """{vec_id: (code, error)} and the codebooks by plain loops."""
    ints = sorted((i, [math.floor(4096 * x) for x in v]) for i, v in rows)
    ints = [(i, v + [0] * (-len(v) % parts)) for i, v in ints]
    w = len(ints[0][1]) // parts
    cut = {(i, p): v[p * w:(p + 1) * w] for i, v in ints for p in range(parts)}
    books = [[cut[i, p] for i, _ in ints[:entries]] for p in range(parts)]

    def near(i, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut[i, p], c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        at = {k: near(*k)[1] for k in cut}
        new = []
        for p in range(parts):
            own = [[cut[i, p] for i, _ in ints if at[i, p] == e] for e in range(len(books[p]))]
            new.append([[sum(x) // len(o) for x in zip(*o)] if o else books[p][e] for e, o in enumerate(own)])
        books = new
    return {i: ([near(i, p)[1] for p in range(parts)], sum(near(i, p)[0] for p in range(parts))) for i, _ in ints}, books


def check(spark, rows, parts=8, entries=16, rounds=6):
    df = spark.createDataFrame([(i, v, i % 3 if i % 4 else None) for i, v in rows], "vec_id long, embedding array<float>, label int")
    got, books = vectors.compress(df.repartition(3), parts=parts, entries=entries, rounds=rounds)
    # What Spark stored, so that both sides see the same floats.
    want, expected_books = brute([(r.vec_id, r.embedding) for r in df.collect()], parts, entries, rounds)
    found = got.collect()
    assert {r.vec_id: (r.code, r.error) for r in found} == want and books.tolist() == expected_books
    sums = {}
    for r in found:
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert all(r.label_error == sums[r.label] for r in found)


def test_equal_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").limit(120).collect()]
    check(spark, rows)
    check(spark, [(i, v[:13]) for i, v in rows[:40]], parts=4, entries=5, rounds=3)
    check(spark, rows[:7])


def test_ties_and_copies(spark):
    check(spark, [(i, [float(i % 2), 1.0, -0.5, float(i % 5)]) for i in range(60)], parts=2, entries=6)


@given(st.lists(st.tuples(*[st.integers(-4, 4)] * 3), min_size=1, max_size=40), st.lists(st.tuples(*[st.integers(-4, 4)] * 3), min_size=1, max_size=20))
def test_search(x, book):
    x, book = np.array(x, np.int64), np.array(book, np.int64)
    at, d = vectors.search(x, book, vectors.neighbour_lists(book))
    every = ((x[:, None] - book[None]) ** 2).sum(-1)
    assert at.tolist() == every.argmin(1).tolist() and d.tolist() == every.min(1).tolist()


def test_search_skips_far_entries():
    book = np.array([[0], [1], [100], [101]], np.int64)
    order, between = vectors.neighbour_lists(book)
    assert order[0].tolist() == [1, 2, 3] and between[0].tolist() == [1, 10000, 10201]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5] * 8, 1, "a"), (1, [0.25] * 8, None, "a"), (None, [0.1] * 8, None, None), (2, None, 1, "b"), (3, [0.1, None] * 4, 1, "c"),
            (4, [nan] * 8, 1, "c"), (5, [inf] + [0.0] * 7, 1, "c"), (6, [1.0] * 5, 2, "c"), (7, [], 2, "c"), (8, [3e38] * 8, 2, "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string")
    got, books = vectors.compress(df)
    # Of equal ids the smaller vector is the first entry; five components are filled up to eight; an
    # empty vector has another length and no code; null ids are last.
    found = sorted((r.vec_id is None, r.vec_id, r.code, r.error) for r in got.collect())
    assert found == [(False, 1, [0] * 8, 0), (False, 1, [1] * 8, 0), (False, 6, [2] * 8, 0), (False, 7, None, None), (False, 8, [3] * 8, 0),
                     (True, None, [4] * 8, 0)]
    assert books[0, :, 0].tolist() == [1024, 2048, 4096, 1 << 28, 409]


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    got, books = vectors.compress(df)
    assert got.count() == 0 and vectors.books_digest(books) == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("name", ["label", "code"])
def test_named_columns(spark, name):
    df = spark.createDataFrame([(1, [1.0, 2.0], 3)], f"error long, v array<double>, `{name}` long")
    got, _ = vectors.compress(df, "error", "v", name, parts=2, entries=1)
    assert [tuple(r) for r in got.collect()] == [(1, 3, [0, 0], 0, 0)]
