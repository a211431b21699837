import hashlib
import random
import re

import numpy as np
import pytest

from lshark.llm import fmindex

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, items, length):
    phrases = {}
    for item, text in items:
        w = words(text)
        if item is None or text is None:
            continue
        for i in range(len(w) - length + 1 if len(w) >= length else min(len(w), 1)):
            phrases.setdefault(tuple(w[i:i + length]), set()).add(str(item))
    out = []
    for doc, text, *_ in docs:
        w = words(text)
        hit, names = set(), set()
        for p, who in phrases.items():
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i:i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
                    names |= who
        joined = ",".join(sorted(names))
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                   for r in fmindex.digest(df).collect()), key=str)


def corpus(seed, vocabulary=6, docs=60):
    rnd = random.Random(seed)
    pool = [f"W{k}" if k % 2 else f"é{k}" for k in range(vocabulary)]
    make = lambda n: " ".join(rnd.choices(pool + ["other", "more!"], weights=[4] * vocabulary + [1, 1], k=n))
    items = [(k, make(rnd.randint(0, 14))) for k in range(25)] + [(7, make(4)), (None, make(9)), (50, None), (51, "...")]
    rows = [(k, make(rnd.randint(0, 80))) for k in range(docs)] + [(None, make(30)), (3, None), (4, ""), (5, "--"), (5, "--")]
    rows += [(100 + k, "start " + items[k][1].upper() + " -- " + items[k][1]) for k in range(10)] * 2
    return rows, items


@pytest.mark.parametrize("seed,length,block", [(0, 10, 1 << 20), (1, 4, 1 << 20), (2, 5, 200), (3, 1, 1 << 20)])
def test_hits_match_brute_force(spark, make_docs, seed, length, block):
    """A block of 200 bytes makes several passes over the documents."""
    docs, items = corpus(seed)
    bench = spark.createDataFrame([(i, t, "d", 1) for i, t in items], "item_id long, text string, id string, spans int")
    got = fmindex.decontaminate(make_docs(docs), bench, length=length, block_bytes=block)
    assert found(got) == brute(docs, items, length)


def test_rows_are_carried_and_spans_are_merged(spark, make_docs):
    bench = spark.createDataFrame([("b", "one two three four"), ("a", "three four five"), ("c", "One, TWO three four!")],
                                  "item_id string, text string")
    docs = [(1, "zero one two three four five six; three four five", "fr")]
    r = fmindex.decontaminate(make_docs(docs), bench, length=3, carry=True).first()
    assert [(x.s, x.e) for x in r.spans] == [(1, 6), (7, 10)] and r["items"] == ["a", "b", "c"]
    assert r.row.doc_id == 1 and r.row.lang == "fr" and r.row.spans == "s" and r.row.text == docs[0][1]


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert fmindex.decontaminate(make_docs([]), none).collect() == []
    r = fmindex.digest(fmindex.decontaminate(make_docs([(1, "a b")]), none)).first()
    assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (2, 0, 0, False)
    assert r.items_sha256 == hashlib.sha256(b"").hexdigest()


def test_a_very_long_text(spark, make_docs, monkeypatch):
    text = "filler word " * 200_000 + "the planted passage of words " + "filler word " * 200_000
    bench = spark.createDataFrame([(1, "The planted passage of words")], "item_id long, text string")
    r = fmindex.decontaminate(make_docs([(1, text), (2, "none")]), bench).where("doc_id = 1").first()
    assert r.n_words == 800_005 and [(x.s, x.e) for x in r.spans] == [(400_000, 400_005)]


@pytest.mark.parametrize("piece", [1, 5, 64, 1 << 20])
def test_words_are_never_cut(piece):
    rnd = random.Random(piece)
    texts = [" ".join("".join(rnd.choices("aB1é中-", k=rnd.randint(0, 9))) for _ in range(rnd.randint(0, 30))).encode()
             for _ in range(40)]
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    h, woff = fmindex.word_hashes(np.frombuffer(b"".join(texts), np.uint8), off, piece)
    flat = [w for t in texts for w in words(t.decode())]
    assert np.diff(woff).tolist() == [len(words(t.decode())) for t in texts]
    seen = {}
    assert len(h) == len(flat) and all(seen.setdefault(w, x) == x for w, x in zip(flat, h.tolist(), strict=True))
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("seed", range(8))
def test_index_finds_all_places(seed):
    """Few symbols and repeated stretches: deep ties, equal suffixes, many stretch ends."""
    rnd = np.random.default_rng(seed)
    stretches = [rnd.integers(1, 2 + seed % 4, rnd.integers(1, 40)).tolist() for _ in range(30)]
    stretches += stretches[:10]
    text = np.array(sum(stretches, []), np.int64)
    left = np.concatenate([np.arange(len(s), 0, -1) for s in stretches])
    order = fmindex.suffix_order(text, left)
    key = [(text[i:i + left[i]].tolist(), i) for i in range(len(text))]
    assert order.tolist() == sorted(range(len(text)), key=lambda i: key[i])
    grid = np.unique(rnd.integers(0, 6, (60, 5)), axis=0)
    grid[np.cumsum(grid[:, ::-1] == 0, 1)[:, ::-1] > 0] = 0
    grid = np.unique(grid[grid[:, -1] > 0], axis=0)
    who, at = fmindex.FMIndex(text, left).find(grid)
    expected = set()
    for k, row in enumerate(grid.tolist()):
        p = [x for x in row if x]
        expected |= {(k, i) for i in range(len(text)) if left[i] >= len(p) and text[i:i + len(p)].tolist() == p}
    assert set(zip(who.tolist(), at.tolist(), strict=True)) == expected and len(who) == len(expected)


def test_wavelet_ranks():
    rnd = np.random.default_rng(5)
    seq = rnd.integers(0, 13, 1000)
    w = fmindex.Wavelet(seq, 4)
    i, c = rnd.integers(0, 1001, 500), rnd.integers(0, 16, 500)
    assert w.rank(c, i).tolist() == [int((seq[:k] == s).sum()) for s, k in zip(c, i, strict=True)]
    i = np.minimum(i, 999)
    symbol, rank = w.get(i)
    assert symbol.tolist() == seq[i].tolist() and rank.tolist() == [int((seq[:k] == seq[k]).sum()) for k in i]
