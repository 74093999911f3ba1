"""Whitening against a library's eigenvectors, and on odd, flat and empty tables."""

import numpy as np
import pytest

from adlake.llm import whitening


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, component string, n string").repartition(3)


def want(rows):
    """vec_id -> (deviation, whitened), and the shares, by numpy."""
    own = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    dims = max(len(v) for _, v in own)
    x = [[int(np.floor(64.0 * c)) + 1_000_000 for c in v] + [1_000_000] * (dims - len(v)) for _, v in own]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    y = np.array([[n * a - b for a, b in zip(r, s, strict=True)] for r in x], dtype=float) / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:32], u[:, ::-1][:, :32]
    return own, [sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True)) for r in x], y @ (u / np.sqrt(e)), e / np.trace(v)


def test_against_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got = whitening.report(frame(spark, [(i, v, "clash", None) for i, v in rows])).collect()
    own, deviation, w, share = want(rows)
    assert len(got) == 32 * len(own) and {r.n for r in got} == {len(own)}
    at = {i: k for k, (i, _) in enumerate(own)}
    out = np.zeros_like(w)
    for r in got:
        out[at[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviation[at[r.vec_id]] and abs(r.explained / share[r.component - 1] - 1) < 1e-9
    sign = np.sign((out * w).sum(axis=0))
    assert np.abs(out * sign - w).max() < 1e-8
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-10


def test_odd(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, float("nan")]), (3, None), (4, [None, 1.0]), (None, [0.5, -0.25]), (5, [float("inf")]), (6, [3.0]), (6, [3.0]), (7, [])]
    got = whitening.report(frame(spark, [(i, v, None, "clash") for i, v in rows])).collect()
    own, deviation, w, share = want(rows)
    assert len(got) == 2 * len(own) and {r.n for r in got} == {len(own)}
    assert sorted(r.deviation for r in got) == sorted(d for d in deviation for _ in range(2))
    assert np.allclose(sorted(abs(r.whitened) for r in got), sorted(np.abs(w).ravel()))
    assert whitening.report(frame(spark, [(1, [1.0], None, None)]).limit(0)).count() == 0
    assert whitening.report(frame(spark, [(1, None, None, None), (2, [], None, None)])).count() == 0


def test_flat(spark):
    """One vector many times: no component has variance; a table with one varying dimension has one."""
    same = whitening.report(frame(spark, [(i, [1.0, 2.0, 3.0], None, None) for i in range(9)])).collect()
    assert {(r.whitened, r.explained, r.identity_error, r.deviation) for r in same} == {(0.0, 0.0, 0.0, 0)} and len(same) == 27
    line = whitening.report(frame(spark, [(i, [float(i), 2.0], None, None) for i in range(9)])).collect()
    assert {r.explained for r in line if r.component == 1} == {1.0} and max(r.identity_error for r in line) < 1e-12
    great = whitening.report(frame(spark, [(1, [3e15, 1.0], None, None), (2, [-3e15, 2.0], None, None), (3, [0.0, 5.0], None, None), (4, [3e38, 0.0], None, None)])).collect()
    assert {r.deviation for r in great} == {None} or len(great) == 6


@pytest.mark.parametrize("n", [1, 2, 5, 64])
def test_components(n):
    rng = np.random.default_rng(n)
    for values in (rng.random(n) + 0.1, np.repeat(2.0, n), np.arange(n) // 2 * 1.0, 10.0 ** -np.arange(n) * (np.arange(n) < 12)):
        q, _ = np.linalg.qr(rng.normal(size=(n, n)))
        a = q @ np.diag(values) @ q.T
        a = (a + a.T) / 2
        e, u = whitening.components(a)
        assert np.abs(e - np.sort(values)[::-1]).max() < 1e-13 * n and np.abs(u.T @ u - np.eye(n)).max() < 1e-12
        assert np.abs(a @ u - u * e).max() < 1e-13 * n
