import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import MinHashLSH
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from brute import exact_pairs, lsh_pairs
from lshark.functions.minhash import fit
from lshark.operators import lsh, prep

M = fit(5, 42)

# Hand-made Jaccard table (FIXTURES.md)
JACCARD = [
    ({1, 2, 3}, {1, 2, 3}, 1.0),
    ({1, 2, 3}, {4, 5}, None),            # disjoint: never returned
    ({1, 2, 3, 4}, {3, 4, 5, 6}, 2 / 6),
    ({7}, {7}, 1.0),
    ({1, 2}, {1, 2, 3, 4, 5}, 2 / 5),     # distance exactly 0.6
]


def _pairs(df):
    return {(r.a, r.b): r.sim for r in df.collect()}


@pytest.mark.parametrize("x,y,sim", JACCARD)
def test_jaccard_table_exact(make_inter, x, y, sim):
    got = _pairs(lsh.exact_jaccard(make_inter({1: x, 2: y}), 1.0, materialize=False))
    if sim is None:
        assert got == {}
    else:
        assert got == {(1, 2): pytest.approx(sim)}


def test_strict_threshold(make_inter):
    inter = make_inter({1: {1, 2}, 2: {1, 2, 3, 4, 5}})
    assert _pairs(lsh.exact_jaccard(inter, 0.6)) == {}
    assert set(_pairs(lsh.exact_jaccard(inter, 0.61))) == {(1, 2)}


def test_identical_sets_always_candidates(make_inter):
    inter = make_inter({1: {1, 2, 3}, 2: {1, 2, 3}, 3: {7}, 4: {7}})
    got = _pairs(lsh.similarity_join(inter, M, 0.5))
    assert got == {(1, 2): 1.0, (3, 4): 1.0}


def test_edge_rows(spark):
    df = spark.createDataFrame(
        [(1, 10), (1, 10), (1, 11), (None, 10), (2, None), (2, 10), (2, 11), (3, 12)],
        "user bigint, item bigint")
    inter = prep.interactions(df, "user", "item")
    assert sorted(map(tuple, inter.collect())) == [(1, 10), (1, 11), (2, 10), (2, 11), (3, 12)]
    got = _pairs(lsh.similarity_join(inter, M, None, strategy="buckets"))
    assert got == {(1, 2): 1.0}


def test_entity_sets(spark):
    df = spark.createDataFrame([(1, 3), (1, 1), (1, 3), (2, 5)], "u bigint, i bigint")
    got = {r.u: (r.n, list(r.items)) for r in prep.entity_sets(df).collect()}
    assert got == {1: (2, [1, 3]), 2: (1, [5])}
    by_item = {r.u: list(r.items) for r in prep.entity_sets(df, by="i").collect()}
    assert by_item == {1: [1], 3: [1], 5: [2]}


def _random_sets(draw_sets):
    return {u: set(s) for u, s in enumerate(draw_sets, start=1) if s}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sets(st.integers(0, 30), min_size=0, max_size=12), min_size=2, max_size=25),
       st.sampled_from([0.3, 0.6, 0.9]))
def test_routes_agree_with_brute_force(make_inter, sets, threshold):
    sets = _random_sets(sets)
    if len(sets) < 2:
        return
    inter = make_inter(sets)
    want = lsh_pairs(sets, M, threshold)
    for strategy in ("buckets", "prefix"):
        got = _pairs(lsh.similarity_join(inter, M, threshold, strategy=strategy, materialize=False))
        assert set(got) == set(want), strategy
        for k in want:
            assert got[k] == pytest.approx(want[k])
    exact = _pairs(lsh.exact_jaccard(inter, threshold, materialize=False))
    assert set(exact) == set(exact_pairs(sets, threshold))
    assert set(want) <= set(exact)                       # LSH answer is a subset of the exact one


def test_hot_groups_split_into_blocks(make_inter):
    # every entity shares item 0, so item 0's bucket holds all of them
    sets = {u: {0, u % 7 + 1, u % 11 + 20} for u in range(1, 60)}
    inter = make_inter(sets)
    plain = _pairs(lsh.similarity_join(inter, M, None, strategy="buckets", block_size=10_000))
    split = _pairs(lsh.similarity_join(inter, M, None, strategy="buckets", block_size=4))
    assert plain == split == pytest.approx(lsh_pairs(sets, M))
    p_plain = _pairs(lsh.exact_jaccard(inter, 0.7, block_size=10_000))
    p_split = _pairs(lsh.exact_jaccard(inter, 0.7, block_size=3))
    assert p_plain == p_split


def test_big_sets_verified_in_long_form(make_inter):
    # sets above big_set are never gathered into arrays; results must not change
    sets = {u: set(range(u % 5, u % 5 + 3 + u % 9)) | {100 + u % 3} for u in range(1, 30)}
    inter = make_inter(sets)
    for thr in (0.5, 0.8):
        want = lsh_pairs(sets, M, thr)
        for strategy in ("buckets", "prefix"):
            got = _pairs(lsh.similarity_join(inter, M, thr, strategy=strategy, big_set=5))
            assert got == pytest.approx(want), (thr, strategy)
        assert set(_pairs(lsh.exact_jaccard(inter, thr, big_set=4))) == set(exact_pairs(sets, thr))
    left = {1: {1, 2, 3, 4, 5, 6}, 2: {10, 11}}
    right = {1: {1, 2, 3, 4, 5}, 5: {10, 11, 12}}
    a = _pairs(lsh.similarity_join_two(make_inter(left), make_inter(right), M, 0.5, big_set=2))
    assert a == pytest.approx({(1, 1): 5 / 6, (2, 5): 2 / 3})


def test_blocked_candidates_equal(make_inter):
    sets = {u: {0, 1, u} for u in range(2, 40)}
    bkt = lsh.buckets(lsh.signatures(make_inter(sets), M))
    a = {tuple(r) for r in lsh.candidates(bkt, block_size=5).collect()}
    b = {tuple(r) for r in lsh.candidates(bkt).collect()}
    assert a == b and all(x < y for x, y in a)
    # first-shared-table emission: no duplicates and no dedupe step
    wh = lsh.buckets(lsh.signatures(make_inter(sets), M), with_hashes=True)
    for block in (5, 10_000):
        rows = lsh.pairs_in_groups(wh, ["tb", "hv"], block_size=block, num_tables=5).collect()
        assert len(rows) == len(set(map(tuple, rows))) and set(map(tuple, rows)) == b


def test_two_table_join(make_inter):
    left = {1: {1, 2, 3}, 2: {10, 11}, 3: {1, 2, 3, 4}}
    right = {1: {1, 2, 3}, 5: {10, 11, 12}, 6: {40}}
    got = _pairs(lsh.similarity_join_two(make_inter(left), make_inter(right), M, 0.5))
    assert got == pytest.approx({(1, 1): 1.0, (3, 1): 0.75, (2, 5): 2 / 3})
    got_split = _pairs(lsh.similarity_join_two(make_inter(left), make_inter(right), M, 0.5, block_size=1))
    assert got_split == got


def test_parity_with_approx_similarity_join(spark, make_inter):
    sets = {u: {(u * 3 + j) % 40 for j in range(4 + u % 5)} for u in range(1, 40)}
    vecs = spark.createDataFrame(
        [(u, Vectors.sparse(40, sorted(s), [1.0] * len(s))) for u, s in sets.items()], ["u", "features"])
    ml = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=5, seed=42).fit(vecs)
    res = ml.approxSimilarityJoin(vecs, vecs, 0.6, distCol="d")
    want = {(r.datasetA.u, r.datasetB.u) for r in res.collect() if r.datasetA.u < r.datasetB.u}
    got = set(_pairs(lsh.similarity_join(make_inter(sets), M, 0.6)))
    assert got == want


def test_neighbors_include_key_and_may_be_short(spark, make_inter):
    sets = {1: {1, 2, 3}, 2: {1, 2, 4}, 3: {50, 51}, 4: {1, 2, 3, 9}}
    got = lsh.neighbors(make_inter(sets), M, 1, 8).collect()
    assert [r.v for r in got][0] == 1 and got[0].sim == 1.0
    assert len(got) <= 3 and 3 not in {r.v for r in got}
    assert [r.rank for r in got] == list(range(1, len(got) + 1))
    assert lsh.neighbors(make_inter(sets), M, 999, 3).count() == 0


def test_neighbors_match_spark_ml(spark, make_inter):
    sets = {u: {(u * 5 + j) % 30 for j in range(3 + u % 4)} for u in range(1, 30)}
    vecs = spark.createDataFrame(
        [(u, Vectors.sparse(30, sorted(s), [1.0] * len(s))) for u, s in sets.items()], ["u", "features"])
    ml = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=5, seed=42).fit(vecs)
    key = Vectors.sparse(30, sorted(sets[1]), [1.0] * len(sets[1]))
    ml_d = sorted(round(r.d, 9) for r in ml.approxNearestNeighbors(vecs, key, 100, distCol="d").collect())
    ours = sorted(round(1 - r.sim, 9) for r in lsh.neighbors(make_inter(sets), M, 1, 100).collect())
    assert ours == ml_d


def test_all_neighbors_top_k(make_inter):
    sets = {1: {1, 2, 3}, 2: {1, 2, 3}, 3: {1, 2}, 4: {1}}
    pairs = lsh.similarity_join(make_inter(sets), M, None, strategy="buckets")
    got = lsh.all_neighbors(pairs, 2).where(F.col("u") == 1).collect()
    assert [(r.v, r.rank) for r in got] == [(2, 1), (3, 2)]


def test_report_counts(make_inter):
    sets = {1: {1, 2, 3}, 2: {1, 2, 3}, 3: {8, 9}}
    inter = make_inter(sets)
    approx = lsh.similarity_join(inter, M, 0.5)
    exact = lsh.exact_jaccard(inter, 0.5)
    cands = lsh.candidates(lsh.buckets(lsh.signatures(inter, M), with_hashes=True))
    n = inter.agg(F.countDistinct("u").alias("n"))
    r = lsh.lsh_report(approx, exact, cands, n).first()
    assert (r.exact_pairs, r.found_pairs, r.true_pairs, r.all_pairs) == (1, 1, 1, 3)
    assert r.recall == 1.0 and r.precision == 1.0


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sets(st.integers(0, 12), min_size=1, max_size=10), min_size=2, max_size=30),
       st.sampled_from([0.1, 0.2, 0.35, 0.5]))
def test_exact_join_tight_thresholds(make_inter, sets, threshold):
    # near-duplicates of similar size: where prefix, size and positional bounds all prune
    sets = _random_sets(sets)
    if len(sets) < 2:
        return
    got = _pairs(lsh.exact_jaccard(make_inter(sets), threshold, materialize=False))
    want = exact_pairs(sets, threshold)
    assert set(got) == set(want)


def test_more_tables_never_lose_a_pair(make_inter):
    sets = {u: {(u * 7 + j * 3) % 40 for j in range(3 + u % 6)} for u in range(1, 45)}
    inter = make_inter(sets)
    few = set(_pairs(lsh.similarity_join(inter, fit(3, 9), 0.7, strategy="buckets")))
    many = set(_pairs(lsh.similarity_join(inter, fit(8, 9), 0.7, strategy="buckets")))
    assert few <= many


def test_shuffled_input_same_output(spark, make_inter):
    sets = {u: {(u * 5 + j) % 25 for j in range(2 + u % 7)} for u in range(1, 40)}
    inter = make_inter(sets)
    shuffled = inter.repartition(7).orderBy(F.rand(3))
    for thr in (None, 0.6):
        a = _pairs(lsh.similarity_join(inter, M, thr))
        b = _pairs(lsh.similarity_join(shuffled, M, thr))
        assert a == b


def test_recall_follows_or_of_tables(spark):
    # each exact pair is found with probability 1 - (1 - J)^5; the observed
    # recall over all pairs of the sf0.01 events must sit close to the mean
    from lshark.plans import catalog
    inter = catalog.event_interactions(spark, "/root/testdata/sf0.01", None)
    exact = lsh.exact_jaccard(inter, 0.6)
    found = lsh.similarity_join(inter, M, 0.6)
    expected = exact.agg(F.avg(1 - F.pow(1 - F.col("sim"), 5))).first()[0]
    recall = found.count() / exact.count()
    assert abs(recall - expected) < 0.03
    assert set(map(tuple, found.select("a", "b").collect())) <= set(map(tuple, exact.select("a", "b").collect()))


def test_prefix_lower_bound_is_a_lower_bound(make_inter):
    sets = {u: {(u * 3 + j * 7) % 23 for j in range(2 + u % 9)} for u in range(1, 60)}
    inter = make_inter(sets)
    bkt = lsh.buckets(lsh.signatures(inter, M), with_hashes=True)
    for thr in (0.3, 0.6, 0.8):
        lower = lsh._prefix_pairs_lower_bound(inter, bkt, thr)
        actual, _ = lsh.group_stats(lsh.prefix_tokens(inter, thr), ["tok"])
        assert lower <= actual


def test_pair_partitions_follow_estimate(spark):
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert lsh.pair_partitions(spark, 0) == base
    assert lsh.pair_partitions(spark, 50 * lsh.PAIRS_PER_PARTITION) == max(base, 50)


def test_one_long_set_changes_nothing_for_short_ones(make_inter):
    """The early overlap check looks at a pair's own sets only."""
    rnd = random.Random(4)
    sets = {u: rnd.sample(range(40), rnd.randrange(2, 12)) for u in range(60)}
    short = {tuple(r)[:3] for r in lsh.similarity_join(make_inter(sets), M, 0.6).collect()}
    long = lsh.similarity_join(make_inter(sets | {999: range(30)}), M, 0.6).collect()
    assert short == {tuple(r)[:3] for r in long if 999 not in (r.a, r.b)}


def test_grouped_neighbors_equal_plain_ones(make_inter):
    rnd = random.Random(5)
    kinds = [rnd.sample(range(30), rnd.randrange(3, 9)) for _ in range(14)]
    inter = make_inter({u: kinds[u % 14 if u % 3 else 0] for u in range(90)})
    for k in (1, 4):
        plain = lsh.all_neighbors(lsh.similarity_join(inter, M, 0.7), k)
        grouped = lsh.grouped_neighbors(inter, M, 0.7, k)
        assert {tuple(r) for r in plain.select("u", "v", "sim", "rank").collect()} \
            == {tuple(r) for r in grouped.select("u", "v", "sim", "rank").collect()}


def test_hot_token_and_hot_entity(spark, make_inter):
    """One element in every set, one entity near every other: same pairs as by hand."""
    sets = {0: list(range(20))} | {u: [x for x in range(20) if x != u % 20] + [100 + u] for u in range(1, 200)}
    got = {(r.a, r.b) for r in lsh.exact_jaccard(make_inter(sets), 0.2, block_size=16).collect()}
    want = {(a, b) for a in sets for b in sets if a < b
            and len(set(sets[a]) & set(sets[b])) / len(set(sets[a]) | set(sets[b])) > 0.8}
    assert got == want and sum(0 in p for p in got) == 199


def test_hot_sides_of_pair_joins_can_be_split(spark, make_inter):
    """Joins on the token and on a pair's entity are plain shuffles, which
    Spark's skew handling splits; nothing fixes their partitioning."""
    sets = {u: [1, 2, 3, 10 + u % 7, 50 + u] for u in range(120)}
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                             "spark.sql.adaptive.autoBroadcastJoinThreshold")
              if spark.conf.get(k, None) is not None}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = lsh.exact_jaccard(make_inter(sets), 0.6)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for k, v in before.items():
            spark.conf.set(k, v)
    final = plan.split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in final and "REPARTITION_BY" not in final


def test_signatures_of_64_bit_ids(make_inter):
    big = {1: [10 ** 18, 3], 2: [3, 10 ** 18], 3: [2038074743 + 5], 4: [5], 5: [-1], 6: [(1 << 63) - 1]}
    got = {r.u: list(r.hashes) for r in lsh.signatures(make_inter(big), M).collect()}
    for u, items in big.items():
        want = [min(((1 + i % 2038074743) % 2038074743 * a + b) % 2038074743 for i in items) for a, b in M.coeffs]
        assert got[u] == want
    pairs = {(r.a, r.b) for r in lsh.similarity_join(make_inter(big), M, 0.5).collect()}
    assert pairs == {(1, 2)}                       # 3 and 4 hash alike but share no element


def test_long_entity_sets_come_in_bounded_rows(make_inter):
    inter = make_inter({1: range(100), 2: range(5)})
    got = prep.entity_sets(inter, most=10).collect()
    assert all(len(r.items) < 40 and list(r.items) == sorted(r.items) for r in got)
    assert sorted(i for r in got if r.u == 1 for i in r.items) == list(range(100))
    assert [(r.n, r.part, list(r.items)) for r in got if r.u == 2] == [(5, 0, [0, 1, 2, 3, 4])]


def test_copies_of_a_hot_group_are_bounded(make_inter, monkeypatch):
    """A group is cut into no more than MOST_BLOCKS blocks, and tasks are bounded."""
    sets = {u: {1, 2 + u % 3} for u in range(60)}
    inter = make_inter(sets)
    want = _pairs(lsh.similarity_join(inter, M, None, strategy="buckets"))
    monkeypatch.setattr(lsh, "MOST_BLOCKS", 3)
    bkt = lsh.buckets(lsh.signatures(inter, M), with_hashes=True)
    got = lsh.candidates(bkt, block_size=4)
    assert {(r.a, r.b) for r in got.collect()} >= set(want)
    two = lsh.similarity_join_two(inter, inter, M, None, block_size=4, strategy="buckets")
    assert {(a, b) for a, b in _pairs(two) if a < b} == set(want)
    assert lsh.pair_partitions(inter.sparkSession, 10 ** 15) == lsh.MOST_PARTITIONS
