"""Prefix routes: a pair is emitted at its first common token only, and two
tables join by prefixes under one token order."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from brute import exact_pairs, jaccard, signature
from lshark.functions.minhash import fit
from lshark.operators import lsh

M = fit(5, 42)
SETS = st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=12), min_size=1, max_size=15)


def pairs(df):
    return {(r.a, r.b): r.sim for r in df.collect()}


def two_sided(left, right, threshold):
    out = {}
    for a, x in left.items():
        for b, y in right.items():
            shared = any(p == q for p, q in zip(signature(x, M), signature(y, M), strict=True))
            if shared and x & y and 1.0 - jaccard(x, y) < threshold:
                out[a, b] = pytest.approx(jaccard(x, y))
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(SETS, SETS, st.sampled_from([0.3, 0.6, 0.9]))
def test_two_tables_by_either_route(make_inter, left, right, threshold):
    left, right = dict(enumerate(left)), dict(enumerate(right, 3))
    want = two_sided(left, right, threshold)
    l, r = make_inter(left), make_inter(right)
    for strategy in ("buckets", "prefix", "auto"):
        assert pairs(lsh.similarity_join_two(l, r, M, threshold, strategy=strategy)) == want, strategy


def test_both_routes_are_counted_where_buckets_form_many_pairs(make_inter, monkeypatch):
    sets = near_copies(9, 30)
    counted = []
    real = lsh.across_stats
    monkeypatch.setattr(lsh, "across_stats", lambda l, r, keys, block: counted.append(keys[0]) or real(l, r, keys, block))
    want = two_sided(sets, sets, 0.7)
    for least, routes in ((5_000_000, ["tb"]), (0, ["tb", "tok"])):
        monkeypatch.setattr(lsh, "PLAN_PAIRS", least)
        counted.clear()
        assert pairs(lsh.similarity_join_two(make_inter(sets), make_inter(sets), M, 0.7)) == want
        assert counted == routes


def near_copies(seed, n=60):
    rnd = random.Random(seed)
    base = [set(rnd.sample(range(200), rnd.randint(10, 30))) for _ in range(8)]
    return {u: base[u % 8] ^ set(rnd.sample(range(200), rnd.randint(0, 3))) for u in range(1, n)}


@pytest.mark.parametrize("index,block,earlier,big", [(0, 3, 64, 50_000), (0, 10_000, 2, 50_000), (100, 10_000, 2, 12), (0, 3, 0, 12)])
def test_routes_of_the_two_table_join(make_inter, monkeypatch, index, block, earlier, big):
    """The smaller side sent as an index, shuffled, or cut into blocks; prefixes
    that carry their tokens or not; sets that are never gathered."""
    monkeypatch.setattr(lsh, "INDEX_ROWS", index)
    monkeypatch.setattr(lsh, "EARLIER", earlier)
    sets = near_copies(block + earlier)
    left, right = {u: s for u, s in sets.items() if u % 3}, {u: s for u, s in sets.items() if u % 4}
    got = lsh.similarity_join_two(make_inter(left), make_inter(right), M, 0.4, block, big, "prefix")
    rows = got.collect()
    assert len(rows) == len({(r.a, r.b) for r in rows})
    assert {(r.a, r.b): r.sim for r in rows} == two_sided(left, right, 0.4)


@pytest.mark.parametrize("earlier", [0, 3, 64])
def test_pairs_come_once(make_inter, monkeypatch, earlier):
    """Near copies meet on many tokens; without carried tokens they are deduplicated."""
    monkeypatch.setattr(lsh, "EARLIER", earlier)
    sets = near_copies(earlier)
    inter = make_inter(sets)
    pre = lsh.prefix_tokens(inter, 0.5)
    met = lsh.pairs_in_groups(pre, ["tok"], 0.5, all_once=earlier == 64).collect()
    assert len(met) == len({(r.a, r.b) for r in met}) and {(r.a, r.b) for r in met} >= set(exact_pairs(sets, 0.5))
    assert pairs(lsh.exact_jaccard(inter, 0.5)) == pytest.approx(exact_pairs(sets, 0.5))


def test_no_dedupe_exchange_where_all_prefixes_carry_their_tokens(make_inter):
    pre = lsh.prefix_tokens(make_inter(near_copies(1)), 0.5)
    plan = lsh.pairs_in_groups(pre, ["tok"], 0.5, stats=(1, 0), all_once=True)._jdf.queryExecution().toString()
    assert plan.count("Aggregate [a") == 0 and "Deduplicate" not in plan


def multiples(seed, first=0):
    """Sets of which many are equal, so that groups of copies are as large as a block of 4 and more."""
    rnd = random.Random(seed)
    base = [set(rnd.sample(range(60), rnd.randint(5, 20))) for _ in range(5)]
    return {first + u: base[u % 5] ^ ({60} if u % 2 else set()) for u in range(50)}


def test_equal_sets_are_verified_once(make_inter, monkeypatch):
    sets, met, was = multiples(3), [], lsh.verify
    monkeypatch.setattr(lsh, "verify", lambda pairs, *x, **y: met.append(pairs.count()) or was(pairs, *x, **y))
    inter = make_inter(sets)
    got = lsh.similarity_join(inter, M, 0.4, block_size=4)
    want = lsh.similarity_join(inter, M, 0.4, strategy="buckets")
    assert got.dtypes == want.dtypes and sorted(got.collect()) == sorted(want.collect())
    kinds = len({frozenset(s) for s in sets.values()})
    assert met[0] <= kinds * (kinds + 1) / 2 < met[1]


def test_equal_sets_of_two_tables_are_verified_once(make_inter, monkeypatch):
    left, right, met, was = multiples(4), multiples(4, 100), [], lsh.verify
    monkeypatch.setattr(lsh, "verify", lambda pairs, *x, **y: met.append(pairs.count()) or was(pairs, *x, **y))
    got = lsh.similarity_join_two(make_inter(left), make_inter(right), M, 0.4, block_size=4)
    want = lsh.similarity_join_two(make_inter(left), make_inter(right), M, 0.4, strategy="buckets")
    assert got.dtypes == want.dtypes and sorted(got.collect()) == sorted(want.collect())
    assert met[0] <= len({frozenset(s) for s in left.values()}) ** 2 < met[1]


def test_repeated_rows_and_nulls_do_not_make_sets_equal(spark):
    rows = [(1, 1), (1, 1), (1, 2), (2, 2), (2, 3), (2, 3), (3, 1), (3, 1), (3, 2), (None, 1), (4, None), (5, None)]
    inter = spark.createDataFrame(rows, "u bigint, i bigint")
    _, members = lsh._copies(inter)
    assert sorted((r.rep, r.u) for r in members.collect()) == [(1, 1), (1, 3), (4, 4), (4, 5)]


def test_more_tokens_than_are_sent_to_the_tasks(make_inter, monkeypatch):
    monkeypatch.setattr(lsh, "BROADCAST_ROWS", 12)
    inter = make_inter(multiples(5))
    want = lsh.similarity_join(inter, M, 0.4, strategy="buckets")
    assert sorted(lsh.similarity_join(inter, M, 0.4).collect()) == sorted(want.collect())


def test_far_pairs_go_before_their_sets_are_fetched(make_inter, monkeypatch):
    rnd = random.Random(8)
    sets = {u: set(rnd.sample(range(300), 40)) for u in range(40)} | {u: set(range(400, 440)) - {u + 360} for u in range(40, 60)}
    inter, model = make_inter(sets), fit(60, 1)                # so many tables that all pairs share a bucket
    pairs = inter.select("u").distinct().alias("x").join(inter.select("u").distinct().alias("y"), F.expr("x.u < y.u"))
    pairs = pairs.select(F.col("x.u").alias("a"), F.col("y.u").alias("b"))
    left = {(r.a, r.b) for r in lsh._plausible(pairs, inter, inter, 0.3, model).collect()}
    near = {p for p, s in exact_pairs(sets, 0.3).items()}
    assert near <= left and len(left) < 2 * len(near) < pairs.count()
    got = lsh.verify(pairs, inter, 0.3, model, check_buckets=True)
    assert {(r.a, r.b) for r in got.collect()} == near


def test_token_weights_go_as_a_table_of_bytes(spark, monkeypatch):
    """No join on the token sends a row per token through the driver, and the order stays rare first."""
    sets = {u: {7, 1000 + u % 2, 2000 + u} for u in range(40)}
    inter = spark.createDataFrame([(u, i) for u, s in sets.items() for i in s], "u bigint, i bigint")
    rows = lsh.prefix_tokens(inter, 0.6)
    assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.tok, r.u, r.n, r.pos) for r in rows.collect()}
    assert {r for r in got if r[0] < 2000} == {(1000 + u % 2, u, 3, 2) for u in sets}      # 2 of 3 tokens, 7 comes last
    freq = spark.createDataFrame([(i, i % 3) for i in range(-1000, 1000)], "i bigint, _w bigint")
    monkeypatch.setattr(lsh, "SLOT_BITS", (16, 16))
    assert lsh._weight_classes(freq).value.nbytes == 1 << 16


def test_only_sets_of_plausible_pairs_are_gathered(make_inter, monkeypatch):
    rnd = random.Random(3)
    sets = {u: set(rnd.sample(range(5000), 40)) for u in range(100)} | {u: set(range(40)) - {u % 40} for u in range(100, 106)}
    gathered, was = [], lsh.profiles
    monkeypatch.setattr(lsh, "profiles", lambda inter, *x: gathered.append(inter.select("u").distinct().count()) or was(inter, *x))
    got = pairs(lsh.similarity_join(make_inter(sets), M, 0.2, strategy="prefix"))
    assert set(got) == {(a, b) for a in range(100, 106) for b in range(a + 1, 106)}
    assert pairs(lsh.similarity_join_two(make_inter(sets), make_inter(sets), M, 0.2, strategy="prefix")).keys() >= got.keys()
    assert gathered[0] == 6 and len(gathered) == 3 and max(gathered) < len(sets) * 2


def test_sets_are_sent_along_with_slices_of_the_pairs(make_inter, monkeypatch):
    monkeypatch.setattr(lsh, "SLICE_BYTES", 1)
    written, was = [], lsh.cut_lineage
    monkeypatch.setattr(lsh, "cut_lineage", lambda df, name="stage": written.append(name) or was(df, name))
    sets = near_copies(4)
    got = lsh.similarity_join(make_inter(sets), M, 0.4, strategy="prefix").collect()
    assert written.count("near-pairs") > 1 and written.count("verified") > 1
    want = lsh.similarity_join(make_inter(sets), M, 0.4, strategy="buckets")
    assert sorted(got) == sorted(want.collect())
