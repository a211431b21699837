"""Top-k search and embedding near-dedup against numpy."""

import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lshark import session
from lshark.llm import mtree, pigeonhole

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, score string"


def vectors(seed, n=260, dim=16):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[40:90] = x[40] + rnd.normal(size=(50, dim)) * 0.05          # a dense group of near copies
    x[100:130] = x[100]                                           # exact copies
    rows = [(i * 3, x[i].astype(np.float32).tolist(), int(i % 2) if not 40 <= i < 130 else 0) for i in range(n)]
    rows += [(9000, None, 0), (9001, [0.0] * dim, 0), (9002, [float("nan")] * dim, 1), (9003, [float("inf")] + [0.0] * (dim - 1), 1),
             (9004, [None] + [0.5] * (dim - 1), 0), (9005, rows[0][1], None), (None, rows[2][1], 0), (9006, [1.0, 0.0], 0),
             (9007, [0.9, 0.1], 0), rows[5], (9008, [], 0), (9009, (x[7] * 3).astype(np.float32).tolist(), 1)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", "s") for r in rows], SCHEMA)


def usable(v, zero=True):
    return v is not None and all(c is not None and np.isfinite(c) for c in v) and (zero or any(v))


@pytest.mark.parametrize("chunk,block", [(1024, 8), (16, 4)])
def test_near_vectors_match_brute_force(spark, chunk, block):
    rows = vectors(1)
    got = pigeonhole.near_duplicates(frame(spark, rows), chunk=chunk, block=block).collect()
    unique = [r for r in {(-1 if r[0] is None else r[0], tuple(r[1]) if r[1] is not None and usable(r[1]) else str(r[1]), r[2]): r
                          for r in rows}.values()]
    good = [r for r in unique if usable(r[1], False) and r[2] is not None and r[1]]
    n = len(good)
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    key = lambda r: -1 if r[0] is None else r[0]
    good.sort(key=key)
    for i in range(n):
        for j in range(i):
            a, b = good[i], good[j]
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                u, v = np.array(a[1], float), np.array(b[1], float)
                if u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.93:
                    links[i] += 1
                    links[j] += 1
                    p, q = find(i), find(j)
                    root[max(p, q)] = min(p, q)
    want = {key(g): (links[i], key(good[find(i)])) for i, g in enumerate(good)}
    assert len(got) == len(rows)
    for r in got:
        k = -1 if r.vec_id is None else r.vec_id
        n_links, component = want.get(k, (0, k))
        assert (r.n_links, -1 if r.component_id is None else r.component_id) == (n_links, component), r
        assert r.kept == (k == component)


def test_stage_tables_hold_each_vector_once(spark):
    x = np.random.default_rng(5).normal(size=(2000, 64)).astype(np.float32)
    x[1000:1200] = x[0] + x[1000:1200] / 50
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)]
    with session.stage_scope(spark):
        got = pigeonhole.near_duplicates(frame(spark, rows)).collect()
        stages = [Path(p.removeprefix("file:")) for p in session._SCOPES.get()[-1]]
        written = sum(f.stat().st_size for s in stages for f in s.rglob("*.parquet"))
    u = x / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (u @ u.T >= 0.93) & (np.arange(2000)[:, None] % 2 == np.arange(2000) % 2)
    assert {r.vec_id: r.n_links for r in got} == dict(enumerate((near.sum(axis=1) - 1).tolist()))
    assert written < 2 * x.nbytes                    # not one copy per block of coordinates and cell


@pytest.mark.parametrize("parts", [(1024, 1 << 15), (16, 32)])
def test_top_k_matches_brute_force(spark, parts):
    rows = vectors(2)
    rows += [(12, rows[50][1], 3), (6, [0.5] * 16, 0)]            # another vector under a used id
    got = mtree.top_k(frame(spark, rows), F.col("vec_id") % 6 == 0, part_rows=parts).collect()
    assert lists(got) == sorted(merged(brute_top(rows, lambda i: i is not None and i % 6 == 0)))


def brute_top(rows, asks, k=5):
    """Sorted lists of ``(rank, id, score)`` per query id, one list per query row."""
    good = [(r[0], [math.floor(256 * float(np.float32(c))) for c in r[1]]) for r in rows if usable(r[1]) and r[1]]
    out = []
    for n, (i, q) in enumerate(good):
        if asks(i):
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), -1 if j is None else j)
                            for m, (j, v) in enumerate(good) if m != n and len(v) == len(q))[:k]
            out.append((i, [(rank, j, -s) for rank, (s, j) in enumerate(scored, 1)]))
    return sorted(x for x in out if x[1])


def lists(got):
    """The same of a result; lists of equal ids are told apart by their order."""
    found = {}
    for r in got:
        found.setdefault(r.query_id, {}).setdefault(r["rank"], []).append((r["rank"], -1 if r.vec_id is None else r.vec_id, r.score))
    out = []
    for i, ranks in found.items():
        n = len(ranks[1])
        assert n == 1 or all(len(x) == n for x in ranks.values())
        if n == 1:
            out.append((i, [ranks[k][0] for k in sorted(ranks)]))
        else:
            out.append((i, sorted(x for k in ranks for x in ranks[k])))
    return sorted(merged(out))


def merged(out):
    """Lists of one id as one sorted list, where a result cannot tell them apart."""
    by = {}
    for i, x in out:
        by.setdefault(i, []).append(x)
    return [(i, x[0] if len(x) == 1 else sorted(y for z in x for y in z)) for i, x in by.items()]


def test_repeated_and_null_ids_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.0], 0), (0, [0.0, 1.0], 0), (0, [1.0, 0.0], 0), (None, [3.0, 3.0], 0), (7, [2.0, 1.0], 0), (50, [0.5, 0.5], 0)]
    got = mtree.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, k=3).collect()
    assert lists(got) == sorted(merged(brute_top(rows, lambda i: i in (0, 50), 3)))
    assert sum(r.vec_id is None and r["rank"] == 1 for r in got) == 4            # every query's best


@pytest.mark.parametrize("scale", [1.0, 3e5, 1e9, 3e13])
def test_scores_of_large_components_are_exact(spark, scale):
    rnd = np.random.default_rng(4)
    v = (rnd.normal(size=(40, 3)) * scale).astype(np.float32)
    v[:, 2] *= 1e-9
    rows = [(k, x.tolist(), 0) for k, x in enumerate(v)]
    if scale > 1e13:
        with pytest.raises(Exception, match="does not fit a long"):
            mtree.top_k(frame(spark, rows), F.col("vec_id") % 5 == 0).collect()
        return
    got = mtree.top_k(frame(spark, rows), F.col("vec_id") % 5 == 0)
    want = brute_top(rows, lambda i: i % 5 == 0)
    if any(abs(s) >= 1 << 63 for _, x in want for _, _, s in x):
        with pytest.raises(Exception, match="does not fit a long"):
            got.collect()
    else:
        assert lists(got.collect()) == want


def test_large_scores_are_told_apart(spark):
    rows = [(0, [1.0], 0), (1, [300000.0], 0), (2, [400000.0], 0)]
    got = mtree.top_k(frame(spark, rows), F.col("vec_id") == 0).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(1, 2, 26214400000), (2, 1, 19660800000)]


def test_fewer_rows_than_k_and_empty_tables(spark):
    rows = [(0, [1.0, 2.0], 0), (1, [1.0, 0.0], 0), (50, [0.5, 0.5], 1)]
    got = mtree.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 50), (0, 2, 1), (50, 1, 0), (50, 2, 1)]
    assert mtree.top_k(frame(spark, []), F.col("vec_id") % 50 == 0).collect() == []
    assert pigeonhole.near_duplicates(frame(spark, [])).collect() == []


def test_tree_skips_distances_and_stays_exact():
    rnd = np.random.default_rng(3)
    centres = rnd.integers(-200, 200, (20, 8))
    x = (centres[rnd.integers(0, 20, 3000)] + rnd.integers(-4, 5, (3000, 8))).astype(np.int64)
    tree = mtree.Tree(np.arange(3000), x)
    calls = [0]
    real = mtree._distance
    try:
        mtree._distance = lambda a, b: (calls.__setitem__(0, calls[0] + len(a)), real(a, b))[1]
        for q in range(0, 3000, 101):
            s = x @ x[q]
            want = sorted((-int(s[i]), i) for i in range(3000) if i != q)[:5]
            assert tree.search(q, x[q], 5) == [(-a, i) for a, i in want]
    finally:
        mtree._distance = real
    assert calls[0] < 30 * 3000 / 10


def test_tree_of_equal_vectors():
    x = np.full((500, 3), 7, np.int64)
    assert mtree.Tree(np.arange(500), x).search(3, x[0], 5) == [(147, i) for i in (0, 1, 2, 4, 5)]


def test_labels_of_any_type(spark):
    rows = [(0, [1.0, 0.0], "a"), (1, [1.0, 0.01], "a"), (2, [1.0, 0.0], "b"), (3, [1.0, 0.0], None), (4, [1.0, 0.02], "b")]
    got = pigeonhole.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(0, 1, 0), (1, 1, 0), (2, 1, 2), (3, 0, 3), (4, 1, 2)]
    rows = [(0, [1.0, 0.0], 1.2), (1, [1.0, 0.0], 1.7), (2, [1.0, 0.0], 1.2)]
    got = pigeonhole.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label double")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(0, 1, 0), (1, 0, 1), (2, 1, 0)]
