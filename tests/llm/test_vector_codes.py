"""Codes of vectors against a plain search through all entries, and the edges of the table."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import vector_codes as vc


def plain(rows, parts=16, entries=64, rounds=2):
    """(vec_id, label, code, error, label_error) and codebooks by looking at every entry."""
    rows = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    x = [[int(np.floor(256 * np.float64(np.float32(v)))) for v in r[1]] for r in rows]
    width = len(x[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in x]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0], rows[i][1]))
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            found = [nearest(v[p], books[p])[1] for v in cut]
            for k in range(len(books[p])):
                mine = [v[p] for v, f in zip(cut, found) if f == k]
                if mine:
                    books[p][k] = tuple(sum(c) // len(mine) for c in zip(*mine))
    out, sums = [], {}
    for r, v in zip(rows, cut):
        near = [nearest(v[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in near)
        sums[r[2]] = sums.get(r[2], 0) + error
        out.append([r[0], r[2], bytes(k for _, k in near), error])
    return sorted((repr((*o, sums[o[1]])) for o in out)), books


def run(spark, rows, **more):
    schema = "vec_id bigint, embedding array<float>, label int, code string, error int, cell int"
    table = spark.createDataFrame([(*r, "x", 1, 1) for r in rows], schema).repartition(3)
    coded, books = vc.compress(table, **more)
    names = ["vec_id", "label", "code", "error", "label_error"]
    got = [(r[0], r[1], bytes(r[2]), r[3], r[4]) for r in coded.select(names).collect()]
    return sorted(map(repr, got)), books


def vectors(n, seed, width=32, digits=2):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(v) for v in rng.normal(0, 0.2, width).round(digits)], int(i % 3)) for i in range(n)]


@pytest.mark.parametrize("seed, n, entries", [(1, 150, 64), (2, 40, 64), (3, 120, 8)])
def test_equals_plain_search(spark, seed, n, entries):
    rows = vectors(n, seed, digits=1 if seed == 3 else 2)  # few distinct values: many ties
    want, books = plain(rows, entries=entries)
    got, ours = run(spark, rows, entries=entries)
    assert got == want
    assert ours.tolist() == [[list(e) for e in b] for b in books]
    text = ",".join(str(x) for b in books for e in b for x in e)
    assert vc.digest(ours) == hashlib.sha256(text.encode()).hexdigest()


def test_edges(spark):
    good = vectors(70, 5)
    rows = [
        *good,
        good[3],  # a repeated row
        (good[4][0], good[5][1], None),  # a repeated id with another vector
        (None, good[6][1], None),
        (-1, None, 1),
        (-2, [], 1),
        (-3, [None, *good[0][1][1:]], 1),
        (-4, [float("nan"), *good[0][1][1:]], 1),
        (-5, [float("-inf"), *good[0][1][1:]], 1),
    ]
    want, _ = plain(rows)
    got, _ = run(spark, rows)
    assert got == want and len(got) == 73


def test_other_lengths_and_huge_components_are_left_out(spark):
    good = vectors(20, 6)
    odd = [(100, good[0][1][:16], 1), (101, good[0][1][:7], 1), (102, [3e38, *good[0][1][1:]], 1)]
    assert run(spark, good + odd)[0] == run(spark, good)[0]


def test_empty_table(spark):
    got, books = run(spark, [])
    assert got == [] and vc.digest(books) == hashlib.sha256(b"").hexdigest()


@settings(deadline=None)
@given(
    st.lists(st.lists(st.integers(-6, 6), min_size=3, max_size=3), min_size=1, max_size=20),
    st.lists(st.lists(st.integers(-9, 9), min_size=3, max_size=3), min_size=1, max_size=20),
)
def test_search_is_exact(book, queries):
    book, queries = np.array(book, np.int64), np.array(queries, np.int64)
    at, best = vc.EqualAverage(book).nearest(queries)
    all_ = ((queries[:, None] - book[None]) ** 2).sum(axis=2)
    assert best.tolist() == all_.min(axis=1).tolist() and at.tolist() == all_.argmin(axis=1).tolist()
