"""Sets over few distinct elements, met block by block."""

import os
import random
import subprocess
import sys
import tracemalloc

import numpy as np
import pytest
from brute import exact_pairs, lsh_pairs
from pyspark.sql import functions as F

from lshark.functions.minhash import fit
from lshark.operators import dense, lsh, topk

M = fit(5, 42)
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    """Every input is worth its blocks, and these are many and small."""
    monkeypatch.setattr(dense, "FROM_PAIRS", 1)
    monkeypatch.setattr(dense, "GROUP_COST", 1e9)
    monkeypatch.setattr(dense, "LEAST_BLOCK", 25)


def sets_of(seed, count=90, first=0):
    """Sets over 70 elements (two words of bits), some equal, some a single element."""
    rnd = random.Random(seed)
    base = [set(rnd.sample(range(-5, 65), rnd.randint(1, 40))) for _ in range(count // 3)]
    return {first + u: set(base[u % len(base)]) ^ set(rnd.sample(range(70), u % 3)) or {0} for u in range(count)}


def sims(df):
    return {(r.a, r.b): r.sim for r in df.collect()}


def by_blocks(monkeypatch, name):
    """The number of calls of one function of the block route."""
    calls, was = [], getattr(dense, name)
    monkeypatch.setattr(dense, name, lambda *x: calls.append(1) or was(*x))
    return calls


@pytest.mark.parametrize("threshold", [0.2, 0.6, 1.0])
def test_exact_jaccard_by_blocks(make_inter, monkeypatch, threshold):
    sets, calls = sets_of(1), by_blocks(monkeypatch, "pairs")
    assert sims(lsh.exact_jaccard(make_inter(sets), threshold)) == pytest.approx(exact_pairs(sets, threshold))
    assert calls


@pytest.mark.parametrize("threshold", [None, 0.3, 0.6, 1.0])
def test_similarity_join_by_blocks(make_inter, monkeypatch, threshold):
    sets, calls = sets_of(2), by_blocks(monkeypatch, "pairs")
    inter = make_inter(sets)
    got = lsh.similarity_join(inter, M, threshold)
    want = lsh.similarity_join(inter, M, threshold, strategy="buckets")
    assert calls and got.dtypes == want.dtypes
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("threshold", [None, 0.3, 0.8])
def test_two_tables_by_blocks(make_inter, monkeypatch, threshold):
    left, right, calls = make_inter(sets_of(3)), make_inter(sets_of(4, 40, 50)), by_blocks(monkeypatch, "pairs")
    got = lsh.similarity_join_two(left, right, M, threshold)
    want = lsh.similarity_join_two(left, right, M, threshold, strategy="buckets")
    assert calls and got.dtypes == want.dtypes
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("k", [1, 4, 200])
def test_nearest_by_blocks(make_inter, monkeypatch, k):
    sets, calls = sets_of(5), by_blocks(monkeypatch, "nearest_pairs")
    monkeypatch.setattr(dense, "FIRST", 2)
    got = topk.nearest(make_inter(sets), M, k)
    near = {}
    for (a, b), sim in lsh_pairs(sets, M).items():
        near.setdefault(a, []).append((-sim, b))
        near.setdefault(b, []).append((-sim, a))
    want = {(u, v): (pytest.approx(-s), r) for u, vs in near.items() for r, (s, v) in enumerate(sorted(vs)[:k], 1)}
    assert calls and {(r.u, r.v): (r.sim, r.rank) for r in got.collect()} == want


def test_ties_of_equal_sets_do_not_leave_their_task(make_inter, monkeypatch):
    monkeypatch.setattr(dense, "FIRST", 4)
    inter = make_inter({u: {1, 2, 3} for u in range(200)})
    sets = dense.bit_sets(inter, dense.elements(inter), M)
    assert dense.nearest_pairs(sets, 200, 3, 3).count() <= 200 * 3 * 4
    got = topk.nearest(inter, M, 3).where("u = 100").select("v").collect()
    assert [r.v for r in got] == [0, 1, 2]


def test_other_keys_and_many_elements_take_the_other_route(spark, make_inter, monkeypatch):
    inter = make_inter({1: {1, 2}, 2: {1, 3}})
    assert dense.elements(inter) == [1, 2, 3]
    assert dense.elements(inter.withColumn("u", F.col("u").cast("string"))) is None
    assert dense.elements(inter.union(spark.createDataFrame([(None, 4)], "u bigint, i bigint"))) is None
    assert dense.elements(inter.union(spark.createDataFrame([(4, None)], "u bigint, i bigint"))) is None
    monkeypatch.setattr(dense, "ITEMS", 2)
    assert dense.elements(inter) is None


def test_few_pairs_in_groups_are_cheaper_than_blocks(make_inter, monkeypatch):
    calls = by_blocks(monkeypatch, "pairs")
    monkeypatch.setattr(dense, "GROUP_COST", 30)
    sets = {u: {u % 300} for u in range(600)}
    lsh.exact_jaccard(make_inter(sets), 0.5).collect()
    assert not calls


@pytest.mark.parametrize("seed", [6, 7])
def test_candidates_by_blocks(make_inter, monkeypatch, seed):
    sets, calls = sets_of(seed), by_blocks(monkeypatch, "sharing_pairs")
    bkt = lsh.buckets(lsh.signatures(make_inter(sets), M), with_hashes=True)
    want = lsh.pairs_in_groups(bkt, ["tb", "hv"], num_tables=5)
    assert sorted(lsh.candidates(bkt).collect()) == sorted(want.collect()) and calls
    part, calls[:] = bkt.where("tb != 1"), []                  # rows of some tables only: the other route
    assert sorted(lsh.candidates(part).collect()) == sorted(lsh.pairs_in_groups(part, ["tb", "hv"], num_tables=5).collect())
    assert not calls


def test_tasks_find_the_package_without_a_path(tmp_path):
    """Python tasks import the package where only the driver has it on its path."""
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from lshark.functions.minhash import fit
from lshark.operators import dense, topk
from lshark.session import get_session
dense.FROM_PAIRS, dense.GROUP_COST = 1, 1e9
spark = get_session("local[2]", 2, extra={{"spark.checkpoint.dir": {str(tmp_path)!r}, "spark.driver.host": "127.0.0.1"}})
inter = spark.createDataFrame([(u, i) for u in range(4) for i in range(3)], "u bigint, i bigint")
print("rows", topk.nearest(inter, fit(5, 42), 2).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows 8" in got.stdout, got.stderr[-2000:]


def test_nearest_over_groups_of_elements_goes_by_blocks(make_inter, monkeypatch):
    """Sets of six groups without a common element: a sixth of the pairs share a bucket,
    and counting those one by one costs more than all pairs by blocks."""
    monkeypatch.setattr(dense, "GROUP_COST", 30)
    rnd, calls = random.Random(8), by_blocks(monkeypatch, "nearest_pairs")
    sets = {40 * g + u: {64 * g + x for x in rnd.sample(range(64), 29)} for g in range(6) for u in range(40)}
    got = topk.nearest(make_inter(sets), M, 3)
    near = {}
    for (a, b), sim in lsh_pairs(sets, M).items():
        near.setdefault(a, []).append((-sim, b))
        near.setdefault(b, []).append((-sim, a))
    want = {(u, v): (pytest.approx(-s), r) for u, vs in near.items() for r, (s, v) in enumerate(sorted(vs)[:3], 1)}
    assert {(r.u, r.v): (r.sim, r.rank) for r in got.collect()} == want
    assert calls


def block_of(seed, count, items, share, first=0):
    """A block as a task unpacks it: sets of random size around ``share`` of the elements."""
    rnd = np.random.default_rng(seed)
    rows = rnd.random((count, items)) < share * rnd.uniform(0.5, 1.0, (count, 1))
    rows[np.arange(count), rnd.integers(0, items, count)] = True
    words = np.packbits(np.pad(rows, ((0, 0), (0, -items % 64))), axis=1, bitorder="little")
    row = {"l_u": np.arange(first, first + count, dtype=np.int64), "l_n": rows.sum(axis=1).astype(np.int64),
           "l_hashes": rnd.integers(0, 2, (count, 2)), "l_bits": words}
    return dense._Side({c: v.tobytes() for c, v in row.items()}, "l", items)


def test_a_tile_of_a_top_k_is_held_once():
    l, r = block_of(1, dense.TILE, 100, 0.6), block_of(2, 4 * dense.WIDE, 100, 0.6, first=10_000)
    tracemalloc.start()
    try:
        dense._nearest_in(l, r, 1)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # the last product is let go only after the next; no table of bounds lies beside them
    assert most < 2.5 * 4 * dense.TILE * dense.WIDE + 2 * r.rows.nbytes


@pytest.mark.parametrize("items, share", [(3, 0.9), (70, 0.1), (300, 1.0), (512, 1.0), (512, 0.02)])
def test_nearest_in_two_blocks_against_all_pairs(items, share):
    l, r = block_of(3, 60, items, share), block_of(4, 300, items, share, first=30)
    got = sorted(zip(*(c.tolist() for c in dense._nearest_in(l, r, 4)), strict=True))
    want = []
    for x in range(60):
        common = [int((l.rows[x] * r.rows[y]).sum()) for y in range(300)]
        near = [(-c / int(l.n[x] + r.n[y] - c), int(r.u[y])) for y, c in enumerate(common)
                if c and l.u[x] != r.u[y] and (l.hashes[x] == r.hashes[y]).any()]
        want += [(int(l.u[x]), v, -s) for s, v in sorted(near)[:4]]
    assert got == sorted(want)


@pytest.mark.parametrize("threshold", [0.3, 0.6])
def test_report_counts_pairs_where_they_meet(make_inter, threshold):
    """Also where the two tables of pairs come from different sets and elements."""
    sets, other = sets_of(11), {u: s | {200 + u % 2} for u, s in sets_of(11).items() if u % 7}
    inter = make_inter(sets)
    exact, n = lsh.exact_jaccard(inter, threshold), inter.agg(F.countDistinct("u").alias("n"))
    cands = lsh.candidates(lsh.buckets(lsh.signatures(inter, M), with_hashes=True))
    for source in (inter, make_inter(other)):
        approx = lsh.similarity_join(source, M, threshold)
        got = lsh.lsh_report(approx, exact, cands, n)
        assert "FullOuter" not in got._jdf.queryExecution().optimizedPlan().toString()
        want = lsh.lsh_report(*[x.select("a", "b") for x in (approx, exact, cands)], n)
        assert got.dtypes == want.dtypes and got.collect() == want.collect()
        assert 0 < got.first().true_pairs < got.first().candidate_pairs
