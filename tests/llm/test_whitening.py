import math
from fractions import Fraction

import numpy as np
import pytest

from biomeframe.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, v int, cell int, component int"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 1, "x", 1, 1, 1) for k, v in rows], SCHEMA)


def brute(rows, wanted):
    """The same with fractions and numpy's own eigenvectors."""
    good = []
    for k, v in rows:
        if v and all(c is not None and math.isfinite(c) for c in v):
            good.append((k, tuple(math.floor(256 * float(np.float32(c))) for c in v)))
    distinct = sorted({x for _, x in good})
    n, size = len(distinct), len(distinct[0])
    sums = [sum(x[j] for x in distinct) for j in range(size)]
    centred = np.array([[float(x[j] - Fraction(sums[j], n)) for j in range(size)] for x in distinct])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    out = []
    for k, x in good:
        far = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        at = np.array([float(a - Fraction(s, n)) for a, s in zip(x, sums)]) @ vectors / np.sqrt(values)
        out += [(k, j + 1, n, far, at[j], values[j] / np.trace(covariance)) for j in range(len(values))]
    return out


@pytest.mark.parametrize("size", [1, 3, 17])
def test_against_brute_force(spark, size):
    rng = np.random.default_rng(size)
    vectors = (rng.normal(size=(150, size)) * np.linspace(3, 0.5, size) + rng.normal(size=size)).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    rows += [(k, rows[7][1]) for k in range(500, 540)] + [(None, rows[3][1]), (9, rows[9][1])]
    bad = [(600, None), (601, [None] * size), (602, [math.nan] * size), (603, [math.inf] * size)]
    got = sorted(whitening.whiten(frame(spark, rows + bad)).collect(), key=repr)
    want = sorted(brute(rows, 4), key=lambda r: repr(r))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [tuple(r)[:4] for r in got] == [r[:4] for r in want]
    signs = {}
    for r, w in zip(got, want):
        sign = signs.setdefault(r.component, 1 if r.whitened * w[4] > 0 else -1)
        assert abs(r.whitened - sign * w[4]) < 1e-9 and abs(r.explained - w[5]) < 1e-9
        assert r.identity_error < 1e-9


def test_without_variance(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, []), (3, [math.nan])])).count() == 0
    alone = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(alone) == 4 and {(r.n, r.deviation, r.whitened, r.explained) for r in alone} == {(1, 0, None, None)}
    line = whitening.whiten(frame(spark, [(k, [float(k), 2.0 * k, 0.0]) for k in range(9)])).collect()
    assert {r.whitened is None for r in line if r.component > 1} == {True}
    assert all(abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-9 for r in line if r.component == 1)


def test_lengths_and_large_entries(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [1.0]), (4, [1.0, 2.0, 3.0])]
    assert {r.vec_id for r in whitening.whiten(frame(spark, rows)).collect()} == {1, 2}
    huge = whitening.whiten(frame(spark, [(1, [1e16, 0.0]), (2, [-1e16, 1.0]), (3, [5.0, 2.0])])).collect()
    assert {r.deviation is None for r in huge} == {True, False} or all(r.deviation is None for r in huge)
    assert all(math.isfinite(r.whitened) for r in huge if r.component == 1)


def test_spectral_splits():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 40):
        q = np.linalg.qr(rng.normal(size=(size, size)))[0]
        for values in (rng.random(size), 10.0 ** -np.arange(size), rng.integers(0, 3, size), np.ones(size)):
            a = q @ np.diag(np.asarray(values, dtype=float)) @ q.T
            a = (a + a.T) / 2
            found, vectors = whitening.principal_components(a, 4)
            assert np.allclose(found, np.sort(values)[::-1][:4], rtol=0, atol=1e-13)
            assert np.allclose(a @ vectors, vectors * found, rtol=0, atol=1e-13)
            assert np.allclose(vectors.T @ vectors, np.eye(len(found)), rtol=0, atol=1e-13)
        u = whitening.polar_factor(q @ np.diag(np.linspace(-1, 1.01, size)) @ q.T)
        assert np.allclose(u @ u.T, np.eye(size), rtol=0, atol=1e-12)
