"""Exact top-k against brute force: ties, repeats, short, null and non-finite vectors, great numbers, many batches."""

import numpy as np
import pytest

from adlake.llm import topk


def brute(rows, k=5, every=50):
    """Rows (vec_id, vector); repeated query ids count with their greatest vector."""
    own = [(i, [int(np.floor(256.0 * c)) for c in v]) for i, v in rows
           if i is not None and v is not None and all(c is not None and np.isfinite(c) and abs(c) < 2.0**54 for c in v)]
    asked = {}
    for i, v in own:
        if i % every == 0:
            asked[i] = max(asked.get(i, v), v)
    out = []
    for q, w in asked.items():
        found = sorted((-max(-(2**63 - 1), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), i) for i, v in own if i != q)  # noqa: B905
        out += [(q, n, i, -s) for n, (s, i) in enumerate(found[:k], start=1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score string, rank string").repartition(3)


def run(spark, rows, **settings):
    df = frame(spark, [(i, v, "clash", None) for i, v in rows])
    return sorted(map(tuple, topk.search(df, df.where("vec_id % 50 = 0"), **settings).collect()))


def test_random(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(c) for c in rng.normal(size=16).astype(np.float32)]) for i in range(900)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, batch=4) == brute(rows)  # several batches of queries
    assert run(spark, rows, k=1) == brute(rows, 1)


def test_odd(spark):
    rows = [(0, [1.0, -1.0]), (50, [0.0, 0.0]), (100, []), (1, [1.0]), (2, [1.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
            (6, [None, 1.0]), (None, [1.0, 1.0]), (2, [1.0, 0.0]), (7, [1.0, 0.0, 9.0]), (150, None), (200, [2.0, 2.0]), (200, [1.0, 1.0]), (-50, [-0.001, 3.0])]
    assert run(spark, rows) == brute(rows)


def test_few_rows_and_none(spark):
    assert run(spark, [(50, [1.0])]) == []
    assert run(spark, [(50, [1.0]), (51, [-2.0])]) == [(50, 1, 51, -131072)]
    assert topk.report(frame(spark, [(1, [1.0], "s", None)]).limit(0)).count() == 0


def test_great_numbers(spark):
    rows = [(0, [1e15, 1.0]), (1, [1e15, 1.0]), (2, [1e9, 0.5]), (3, [-1e15, 2.0]), (50, [3e9, 1.0]), (4, [3e38, 1.0])]
    assert run(spark, rows) == brute(rows)


def test_one_vector_many_times(spark):
    rows = [(i, [0.5, -0.25, 0.125]) for i in range(3000)] + [(5000 + i, [0.1 * i, 0.0, 0.0]) for i in range(8)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("steps", [1, 3, 8])
def test_bounds_leave_no_row_out(steps):
    """The rows that remain hold the k best, and most others are never resolved."""
    rng = np.random.default_rng(steps)
    x, q = rng.integers(-200, 200, (1000, 32)), rng.integers(-200, 200, (40, 32))
    score = x @ q.T
    best = np.sort(score, axis=0)[-5:]
    floor = np.full(40, -topk.LIMIT)
    query, row, got = topk.qualify(x, q, floor, 5, steps)
    assert (got == score[row, query]).all()
    for j in range(40):
        assert set(best[:, j]) <= set(got[query == j].tolist())
    if steps == 8:
        query, row, got = topk.qualify(x, q, best[0], 5, steps)  # the k-th best is known from other blocks
        assert len(row) < 0.05 * score.size and all((got[query == j] >= best[0, j]).sum() >= 5 for j in range(40))
