"""BagMinHash near-dedup against exact weighted Jaccard."""

import random
from collections import Counter

import numpy as np
import pytest

from lshark.llm import bagminhash, components
from lshark.llm.common import NULL_ID


def bag(text):
    w = (text or "").encode().split()
    return Counter([tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else ([tuple(w)] if w else []))


def similarity(a, b):
    both = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 0.0


def brute(rows):
    """Class id per row index by union of all pairs at 0.8."""
    bags, root = [bag(r[1]) for r in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and similarity(bags[i], bags[j]) >= 0.8:
                root[find(i)] = find(j)
    key = lambda r: NULL_ID if r[0] is None else r[0]
    low = {}
    for i, r in enumerate(rows):
        low[find(i)] = min(low.get(find(i), key(r)), key(r))
    return [None if low[find(i)] == NULL_ID else low[find(i)] for i in range(len(rows))]


def edited(rnd, words, share):
    return [rnd.choice("qrstuv") * 3 if rnd.random() < share else w for w in words]


def corpus(seed):
    rnd = random.Random(seed)
    vocab = ["w%d" % i for i in range(500)]
    rows = []
    for group in range(12):
        base = [rnd.choice(vocab) for _ in range(rnd.randrange(60, 400))]
        for k in range(rnd.randrange(1, 9)):
            rows.append((len(rows) * 7 % 1009, " ".join(edited(rnd, base, 0.004 * k))))
    rows += [(2000, "one two"), (2001, "one  two"), (2002, None), (2003, ""), (2004, " \n"), (None, rows[0][1]),
             (2005, "same " * 60), (2006, "same " * 66), (2007, "same " * 90), (2008, rows[1][1]), (2008, rows[1][1]),
             (2009, " ".join(rnd.choice(vocab) for _ in range(30000)))]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_match_brute_force(make_docs, seed):
    rows = corpus(seed)
    got = bagminhash.near_duplicates(make_docs(rows)).collect()
    want = brute(rows)
    assert sorted((str(r.doc_id), str(r.class_id)) for r in got) == sorted((str(r[0]), str(c)) for r, c in zip(rows, want))
    kept = [r for r in got if r.kept]
    assert {r.class_id for r in kept} == set(want) and all(r.doc_id == r.class_id for r in kept)


def test_large_buckets_are_compared_within_tasks(make_docs, monkeypatch):
    """Variants of one text whose pairwise similarities lie on both sides of the threshold."""
    monkeypatch.setattr(bagminhash, "PAIRED", 3)
    monkeypatch.setattr(bagminhash, "CHUNK", 5)
    rnd = random.Random(9)
    base = ["w%d" % rnd.randrange(900) for _ in range(200)]
    rows = [(i, " ".join(edited(rnd, base, 0.012 + 0.0006 * i))) for i in range(60)]
    got = bagminhash.near_duplicates(make_docs(rows)).collect()
    want = brute(rows)
    assert 3 < len(set(want)) < 50
    assert sorted((r.doc_id, r.class_id) for r in got) == [(r[0], c) for r, c in zip(rows, want)]


def test_keep_one_keeps_columns_and_one_row_per_class(make_docs):
    rows = corpus(3)
    docs = make_docs(rows)
    got = bagminhash.keep_one(docs).collect()
    assert got[0].asDict().keys() == dict.fromkeys(docs.columns).keys() and got[0].d == "x"
    assert sorted(map(str, (r.doc_id for r in got))) == sorted(map(str, set(brute(rows))))


def test_one_id_with_two_texts(make_docs):
    a, b = " ".join("abcdefghij" * 3), " ".join("klmnopqrst" * 3)
    got = bagminhash.near_duplicates(make_docs([(1, a), (1, b), (2, b)])).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == [(1, 1), (1, 1), (2, 1)]


def test_empty_table(make_docs):
    assert bagminhash.near_duplicates(make_docs([])).collect() == []


def test_signatures_estimate_weighted_jaccard_without_bias():
    rnd = np.random.default_rng(4)
    wanted, found = [], []
    for _ in range(60):
        n = int(rnd.integers(5, 60))
        a, b = rnd.integers(0, 40, n) * 1, rnd.integers(0, 40, n) * 1
        k = rnd.random(n) < 0.5
        a[k] = b[k] = 0
        h = rnd.integers(1, 1 << 62, n).astype(np.uint64)
        a, b = a + rnd.integers(0, 3, n), b + rnd.integers(0, 3, n)
        x, y = a > 0, b > 0
        if not x.any() or not y.any():
            continue
        sig = bagminhash.signatures(np.concatenate((h[x], h[y])), np.repeat([0, 1], [x.sum(), y.sum()]),
                                    np.concatenate((a[x], b[y])), 2, m=256)
        wanted.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        found.append((sig[0] == sig[1]).mean())
    error = np.array(found) - wanted
    assert abs(error.mean()) < 0.012 and np.abs(error).max() < 0.14


def test_components_of_chains_stars_and_loops(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)] + [(5, 5), (9, 300), (300, 301)]
    edges += [(rnd.randrange(1000, 1100), rnd.randrange(1000, 1100)) for _ in range(90)]
    rnd.shuffle(edges)
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_columns_of_any_name_keep_their_values(spark):
    rows = [(1, "one two three four five six", 7, 8), (2, "one two three four five six", 9, 9), (3, None, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key_d long, f long")
    got = bagminhash.keep_one(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [rows[0], rows[2]]


def test_all_pairs_of_a_bucket_can_be_verified(make_docs):
    rows = [(k, " ".join(f"w{(k // 4) * 100 + j if j % 9 else j + k}" for j in range(60))) for k in range(24)]
    every = bagminhash.near_duplicates(make_docs(rows), max_bits=None).collect()
    assert {(r.doc_id, r.class_id) for r in every} == {(r.doc_id, r.class_id) for r in bagminhash.near_duplicates(make_docs(rows)).collect()}
