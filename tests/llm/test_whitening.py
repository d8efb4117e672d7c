"""Whitening against exact fractions and numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest

from farespan.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, component int"


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def brute(rows, dims):
    kept = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in rows if usable(v) and len(v) == dims]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = [Fraction(s, n) for s in sums]
    cov = [[float(sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in fit) / n) for j in range(dims)] for i in range(dims)]
    return kept, fit, n, sums, np.array(cov)


@pytest.fixture(scope="module")
def rows():
    rnd = np.random.default_rng(2)
    mixing = rnd.normal(size=(6, 6))
    vectors = (rnd.normal(size=(150, 6)) @ mixing).round(2).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [(200 + i, vectors[3]) for i in range(40)] + [(7, vectors[7]), (None, vectors[8])]
    rows += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0]), (304, [float("inf")] + [0.0] * 5), (305, [1.0, 2.0]), (306, [-0.0] * 6)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "clash", 3) for i, v in rows], SCHEMA)


def test_matches_exact_covariance(spark, rows):
    kept, fit, n, sums, cov = brute(rows, 6)
    out = whitening.whiten(frame(spark, rows).repartition(4)).collect()
    assert len(out) == 4 * len(kept) and {r.n for r in out} == {n}
    value, axis = np.linalg.eigh(cov)
    value, axis = value[::-1], axis[:, ::-1]
    want = {}
    for i, x in kept:
        t = [n * c - s for c, s in zip(x, sums)]
        w = (np.array([float(Fraction(v, n)) for v in t]) @ axis[:, :4]) / np.sqrt(value[:4])
        want.setdefault(i, []).append((sum(v * v for v in t), w))
    signs = {}
    for r in out:
        deviation, w = want[r.vec_id][0]
        assert r.deviation == deviation and r.deviation_exact == str(deviation)
        assert abs(r.explained - value[r.component - 1] / np.trace(cov)) < 1e-9
        assert abs(abs(r.whitened) - abs(w[r.component - 1])) < 1e-7
        if abs(r.whitened) > 1e-6:
            signs.setdefault(r.component, set()).add(np.sign(r.whitened) == np.sign(w[r.component - 1]))
        assert r.identity_error < 1e-9
    assert all(len(s) == 1 for s in signs.values()) and set(signs) == {1, 2, 3, 4}


def test_polarisation_gives_exact_sums():
    rnd = np.random.default_rng(5)
    for top in (10, 1 << 30, 1 << 44):
        x = rnd.integers(-top, top, size=(50, 3))
        sums = [int(s) for s in x.astype(object).sum(axis=0)]
        t = whitening.centred(x, 50, sums)
        exact = [[sum((50 * int(a) - sums[i]) * (50 * int(b) - sums[j]) for a, b in zip(x[:, i], x[:, j])) for j in range(3)] for i in range(3)]
        squared = {}
        for i in range(3):
            for j in range(i, 3):
                u = t[:, i : i + 1] + (t[:, j : j + 1] if j > i else 0)
                squared[i, j] = whitening.squares(u)[0]
        for i in range(3):
            assert squared[i, i] == exact[i][i]
            for j in range(i + 1, 3):
                assert squared[i, j] - squared[i, i] - squared[j, j] == 2 * exact[i][j]


def test_very_large_entries_stay_exact(spark):
    rows = [(1, [3e16, 1.0]), (2, [-3e16, 2.0]), (3, [1e38, 0.5])]
    out = whitening.whiten(frame(spark, rows)).collect()
    assert len(out) == 6 and all(r.deviation is None and int(r.deviation_exact) > 1 << 63 for r in out)


def test_degenerate_tables(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    same = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.identity_error) for r in sorted(same)] == [(i, k, 1, 0, None, None) for i in (1, 2) for k in (1, 2)]
    line = whitening.whiten(frame(spark, [(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [2.0, 2.0])])).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in line) and {round(r.explained, 9) for r in line} == {0.0, 1.0}
