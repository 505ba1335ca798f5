"""Embedding near-dedup against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from tallyspark.llm.embedding_dedup import calibrate, near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, links string"


def brute(ids, m, least=0.95):
    m = np.asarray(m, np.float32).astype(float)
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    link = u @ u.T >= least
    np.fill_diagonal(link, False)
    comp = np.array(ids)
    while True:
        new = np.array([min([comp[i], *comp[link[i]]]) for i in range(len(ids))])
        if (new == comp).all():
            return {i: (int(s), int(c), bool(i == c)) for i, s, c in zip(ids, link.sum(axis=1), comp)}
        comp = new


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(df, **kw).collect()}


@pytest.mark.parametrize("hot", [2048, 16])
def test_against_all_pairs(spark, hot):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((300, 32))
    near = [base[i % 20] + rng.standard_normal(32) * s for i in range(150) for s in (0.05, 0.12)]
    same = [base[3]] * 40
    m = np.vstack([base, near, same]).astype(np.float32)
    ids = [int(i) for i in rng.permutation(len(m)) * 3 + 1]
    got = run(spark, list(zip(ids, m.tolist())), hot=hot)
    want = brute(ids, m)
    right = sum(got[i] == want[i] for i in ids)
    found, there = sum(g[0] for g in got.values()), sum(w[0] for w in want.values())
    assert all(got[i][0] <= want[i][0] for i in ids)      # nothing below the cosine
    assert found >= 0.97 * there and right >= 0.9 * len(ids)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, []), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (None, [1.0, 0.0]), (11, [1e-30, 0.0]), (12, [3e38, 3e37])]
    got = run(spark, rows)
    assert got[1] == (3, 1, True) and got[2] == (3, 1, False) and got[11] == (3, 1, False) and got[12] == (3, 1, False)
    for i in (3, 4, 5, 6, 7, 8, 9, 10):
        assert got[i] == (0, i, True)
    assert got[None] == (0, None, False)
    assert run(spark, []) == {}
    assert run(spark, [(1, None)]) == {1: (0, 1, True)}


def test_plan_grows_slowly():
    plans = [calibrate(10 ** k) for k in (2, 4, 6, 9)]
    assert [p.per_table for p in plans] == sorted(p.per_table for p in plans)
    assert plans[-1].tables < 200
