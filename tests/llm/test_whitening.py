"""Whitening against numpy over all rows."""

import math
import random

import numpy as np
import pytest

from terrarank.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, x string, times int, n long"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, "clash", 0, 9) for k, v in rows], SCHEMA)


def slow(rows, dim, weights="one"):
    """{(id, x): (n, deviation, whitened, explained)} with float64 numpy on the distinct vectors."""
    kept = [(k, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for k, v in rows
            if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    times = {}
    for _, x in kept:
        times[x] = times.get(x, 0) + 1 if weights == "count" else 1
    fit = np.array([list(x) for x in times], dtype=object)
    w = np.array(list(times.values()), dtype=object)
    n, total = int(w.sum()), (fit * w[:, None]).sum(axis=0)
    c = (fit * n - total).astype(float) / n
    cov = (c * w[:, None].astype(float)).T @ c / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for k, x in kept:
        d = [n * int(v) - int(s) for v, s in zip(x, total)]
        out[k, x] = n, sum(v * v for v in d), np.array([v / n for v in d]) @ vectors[:, :4] / np.sqrt(np.maximum(values[:4], 1e-300)), values[:4] / np.trace(cov)
    return out


def cases(dim=6, n=300, offset=0.0):
    rnd = np.random.default_rng(1)
    shape = rnd.normal(size=(dim, dim)) * np.array([3, 2, 1, .5, .3, .1][:dim])
    rows = [(i, (rnd.normal(size=dim) @ shape + offset).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(2 * n)]  # one vector in two thirds of the rows
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (None, rows[8][1])]
    rows += [(2000, None), (2001, []), (2002, [1.0] * (dim - 1)), (2003, [1.0] * (dim - 1) + [None]), (2004, [float("nan")] * dim),
             (2005, [float("inf")] + [0.0] * (dim - 1)), (2006, [-0.0] * dim), (2007, [0.0] * dim)]
    random.Random(2).shuffle(rows)
    return rows


@pytest.mark.parametrize("weights, offset", [("one", 0.0), ("count", 0.0), ("one", 5000.0)])
def test_equals_numpy(spark, weights, offset):
    rows = cases(offset=offset)
    want = slow(rows, 6, weights)
    got = W.whiten(frame(spark, rows).repartition(5), weights=weights).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, []).append(r)
    valid = [k for k, v in rows if v is not None and len(v) == 6 and all(c is not None and math.isfinite(c) for c in v)]
    assert len(got) == 4 * len(valid) and {r.component for r in got} == {1, 2, 3, 4}
    signs = {}
    for (k, _), (n, deviation, white, explained) in want.items():
        same = [r for r in by_id[k] if r.deviation == deviation]
        assert {r.n for r in same} == {n} and len(same) >= 4
        for r in same:
            c = r.component - 1
            signs.setdefault(c, np.sign(r.whitened * white[c]))
            assert r.whitened == pytest.approx(signs[c] * white[c], rel=1e-7, abs=1e-8)
            assert r.explained == pytest.approx(explained[c], rel=1e-9)
    assert {r.identity_error for r in got} == {got[0].identity_error} and 0 <= got[0].identity_error < 1e-9


def test_distinct_vectors_are_whitened_once_and_joined_back(spark):
    rows = cases()
    done = W.whiten(frame(spark, rows))
    copies = {(r.component, r.whitened, r.deviation) for r in done.where("vec_id >= 1000 and vec_id < 1600").collect()}
    assert len(copies) == 4


def test_degenerate_tables(spark):
    empty = frame(spark, [])
    assert W.whiten(empty).collect() == [] and W.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    assert W.whiten(empty).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    one = W.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(one) == 4 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(1, 0, None, None, None)}
    line = W.whiten(frame(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)])).collect()  # rank 1
    assert {r.component for r in line if r.whitened is not None} == {1} and line[0].identity_error < 1e-12


def test_large_numbers_stay_exact(spark):
    rows = [(i, [1e9 + 1e7 * i, -3e12, 5.0]) for i in range(7)]
    got = {r.vec_id: r.deviation for r in W.whiten(frame(spark, rows), components=1).collect()}
    want = {k: v[1] for (k, _), v in slow(rows, 3).items()}
    assert got == {k: v if v < 1 << 63 else None for k, v in want.items()} and None in got.values()
    far = W.whiten(frame(spark, [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])])).collect()
    assert len(far) == 6 and all(r.deviation is None or r.deviation >= 0 for r in far)
