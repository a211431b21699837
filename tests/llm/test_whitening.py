import math
from fractions import Fraction

import numpy as np
import pytest

from lshark.llm import whitening


def make(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<float>, w string, v double")


def brute(rows):
    kept = [(i, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [v for _, v in kept]
    n, dim = len(x), len(x[0])
    s = [sum(c) for c in zip(*x, strict=True)]
    dev = [sum((n * a - b) ** 2 for a, b in zip(v, s, strict=True)) for v in x]
    z = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(v, s, strict=True)] for v in x])
    e, u = np.linalg.eigh(z.T @ z / n)
    order = np.argsort(-e)[:8]
    return [i for i, _ in kept], dev, z @ u[:, order] / np.sqrt(e[order]), e[order] / e.sum(), dim


@pytest.mark.parametrize("dim,n", [(5, 40), (12, 300)])
def test_matches_brute_force(spark, dim, n):
    rnd = np.random.default_rng(dim)
    v = (rnd.normal(size=(n, dim)) * np.arange(1, dim + 1) + 3).astype(np.float32)
    rows = [(k, [float(c) for c in r]) for k, r in enumerate(v)]
    rows += [(900, None), (901, [None] * dim), (902, [math.nan] + [1.0] * (dim - 1)), (903, [math.inf] * dim), (904, [1.0])]
    rows += [(None, rows[0][1]), (0, rows[1][1])]
    ids, dev, w, share, _ = brute([r for r in rows if r[0] != 904])
    got = {}
    for r in whitening.digest(whitening.whiten(make(spark, rows))).collect():
        got.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    k = min(8, dim)
    assert len(got) == len(ids) == n + 2
    sign = None
    for row, (i, d) in enumerate(zip(ids, dev, strict=True)):
        parts = got[i, d]
        assert sorted(parts) == list(range(1, k + 1)) and all(p.n == n + 2 for p in parts.values())
        values = np.array([parts[c + 1].whitened for c in range(k)])
        sign = np.sign(values * w[row]) if sign is None else sign
        assert np.allclose(values, sign * w[row], rtol=1e-8, atol=1e-9)
        assert np.allclose([parts[c + 1].explained for c in range(k)], share, rtol=1e-9)
        assert all(p.identity_error < 1e-9 for p in parts.values())


def test_without_variance_there_is_no_row(spark):
    assert whitening.whiten(make(spark, [])).collect() == []
    assert whitening.whiten(make(spark, [(1, None), (2, [])])).collect() == []
    assert whitening.whiten(make(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(make(spark, [(1, [1.0, 2.0])] * 5)).collect() == []
    flat = whitening.whiten(make(spark, [(1, [1.0, 2.0]), (2, [1.0, 3.0])])).collect()
    assert sorted((r.vec_id, r.component, abs(round(r.whitened, 9)), r.explained) for r in flat) == [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]


@pytest.mark.parametrize("size", [10.0, 1e5, 1e9, 1e14])
def test_sums_are_exact_at_any_size(size):
    rnd = np.random.default_rng(3)
    z = np.floor(rnd.normal(size=(700, 4)) * size).astype(np.int64)
    big = z.astype(object)
    pairs = [(big[:, i] + big[:, j]) for i in range(4) for j in range(i + 1, 4)]
    assert whitening.squares(z) == [*(big * big).sum(0)] + [(p * p).sum() for p in pairs]
    assert whitening.column_sums(z) == [*big.sum(0)]
    rest = [3, -2, 0, 1]
    y = 700 * big - np.array(rest, object)
    assert whitening.square_norms(z, 700, rest) == [*(y * y).sum(1)]


@pytest.mark.parametrize("x", [0, 1, -1, 1 << 39, -(1 << 40), 10 ** 50, -(10 ** 50)])
def test_limbs(x):
    assert whitening.unlimb(whitening.limbs(x)) == x


def test_polarisation_gives_the_covariance():
    rnd = np.random.default_rng(1)
    z = rnd.integers(-500, 500, (200, 6))
    n, s = 200, z.sum(0)
    v, _ = whitening.covariance(n, [int(x) for x in s], whitening.squares(z))
    assert np.allclose(v, np.cov(z.T, bias=True), rtol=1e-12, atol=1e-9)
