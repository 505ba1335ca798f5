"""Whitening against numpy's eigenvectors and whole-number sums in Python."""

import math
import random

import numpy as np
import pytest

from tallyspark.llm import whitening


def cases():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 16, 64):
        a = rng.standard_normal((n + 5, n))
        yield a.T @ a
    a = rng.standard_normal((100, 40)) * np.logspace(0, -6, 40)
    yield a.T @ a
    q, _ = np.linalg.qr(rng.standard_normal((32, 32)))
    for values in ([3.0] * 10 + [2.0] * 10 + [1.0] * 10 + [0.0] * 2, [1e6, *[1 + 1e-9 * i for i in range(31)]]):
        m = q @ np.diag(values) @ q.T
        yield (m + m.T) / 2
    b = rng.standard_normal((10, 64))
    yield b.T @ b
    yield from (np.eye(8), np.zeros((4, 4)), np.ones((20, 20)), np.array([[0.0, 1], [1, 0]]), np.diag([5.0, 5, 5, 1, 1, 0]))


@pytest.mark.parametrize("v", list(cases()), ids=lambda v: str(len(v)))
def test_components_equal_eigenvectors(v):
    values, vectors = whitening.spectral_components(v)
    size = max(np.abs(np.linalg.eigvalsh(v)).max(), 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(v)[::-1]).max() <= 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(v))).max() < 1e-13
    assert np.abs(v @ vectors - vectors * values).max() <= 1e-13 * size


def test_polar_factor():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((12, 12))
    a = a + a.T
    u, _, w = np.linalg.svd(a)
    assert np.abs(whitening.polar_factor(a) - u @ w).max() < 1e-12


def model(rows, k=16):
    """``rows``: (id, vector) that are kept."""
    x = {i: [math.floor(64 * float(c)) + 1_000_000 for c in v] for i, v in rows}
    fit = np.array(sorted({tuple(v) for v in x.values()}), object)
    n, s = len(fit), [int(t) for t in fit.sum(axis=0)]
    mean = [t / n for t in s]
    centred = (n * fit - np.array(s, object))
    v = np.array([[int(c) / n ** 3 for c in row] for row in centred.T.dot(centred)], float)
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    k = min(k, int((e > 1e-12 * e[0]).sum()))
    out = {}
    for i, row in x.items():
        off = [n * c - t for c, t in zip(row, s)]
        z = (np.array([o / n for o in off]) @ q[:, :k]) / np.sqrt(e[:k])
        out[i] = (n, sum(o * o for o in off), z, e[:k] / np.trace(v))
    return out, mean


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, id string, n int")


def check(spark, rows, kept, k=16):
    out = whitening.whiten(frame(spark, rows), components=k).collect()
    want, _ = model(kept, k)
    size = len(next(iter(want.values()))[3])
    assert len(out) == len(kept) * size
    first = {}
    for r in out:
        n, deviation, z, explained = want[r.vec_id]
        assert r.n == n and r.deviation == deviation and 0 <= r.identity_error < 1e-10
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        sign = first.setdefault(r.component, math.copysign(1, r.whitened * z[r.component - 1]) if abs(z[r.component - 1]) > 1e-6 else None)
        if sign is None:
            del first[r.component]
            sign = 1 if abs(r.whitened - z[r.component - 1]) < 1e-6 else -1
        assert r.whitened == pytest.approx(sign * z[r.component - 1], abs=1e-8)


def test_rows(spark):
    rnd = random.Random(2)
    kept = [(i, [rnd.gauss(j, 1 + j / 4) for j in range(20)]) for i in range(300)]
    kept += [(1000 + i, kept[0][1]) for i in range(200)]  # one vector holds many rows
    bad = [(2000, None), (2001, [None] * 20), (2002, [float("nan")] + [0.0] * 19), (2003, [float("inf")] * 20), (2004, []),
           (2005, [1.0, 2.0])]
    kept = [(i, [float(np.float32(c)) for c in v]) for i, v in kept]
    check(spark, kept + bad, kept)
    check(spark, kept + bad, kept, k=5)


def test_few_and_dependent_vectors(spark):
    kept = [(1, [0.0, 1.0, 2.0]), (2, [1.0, 1.0, 4.0]), (3, [1.0, 1.0, 4.0]), (4, [3.0, 1.0, 8.0])]
    check(spark, kept, kept)  # one component: a constant and a dependent dimension
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, []), (None, [])], [(1, None)]):
        assert whitening.whiten(frame(spark, rows)).collect() == []


def test_null_ids_and_large_entries(spark):
    rows = [(None, [1e13, -2.0]), (None, [1e13, -2.0]), (5, [-1e13, 4.0]), (6, [3e38, 0.5])]
    out = whitening.whiten(frame(spark, rows)).collect()  # the second component is lost in the first one's rounding
    assert len(out) == 4 and sum(r.vec_id is None for r in out) == 2
    assert {r.n for r in out} == {3} and all(r.identity_error < 1e-4 for r in out)
    rows = [(None, [1e5, -2.0]), (None, [1e5, -2.0]), (5, [-1e5, 4.0]), (6, [3e5, 0.5])]
    out = whitening.whiten(frame(spark, rows)).collect()
    assert len(out) == 8 and sum(r.vec_id is None for r in out) == 4 and all(r.identity_error < 1e-4 for r in out)
