"""Word-window and byte-string dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from lshark.llm import hashing, substring, suffix


def corpus(seed, n=40):
    rnd = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)] + ["é", "漢字", "a", "!!"]
    passages = [[rnd.choice(vocab) for _ in range(rnd.randrange(15, 60))] for _ in range(4)]
    rows = []
    for i in range(n):
        ws = [rnd.choice(vocab) for _ in range(rnd.randrange(0, 80))]
        if rnd.random() < 0.5:
            at = rnd.randrange(0, len(ws) + 1)
            ws[at:at] = rnd.choice(passages)
        rows.append((i, "".join(w + rnd.choice([" ", "  ", "\n", "\t "]) for w in ws)))
    long = [rnd.choice(vocab) for _ in range(4000)]
    rows += [(100, " ".join(long)), (101, " ".join(long[1000:3000])), (102, rows[3][1]), (103, "x " * 90),
             (104, "b" * 900), (105, ""), (106, None), (None, rows[5][1]), (107, " \n "), (5, rows[5][1]),
             (108, " ".join(passages[0])), (109, "ab" * 200)]
    return rows


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_words(rows, length):
    """Kept words per row; rows that repeat id and text are one place."""
    first, key = {}, lambda r: (-1 << 63) if r[0] is None else r[0]
    for r in rows:
        w = words(r[1])
        for i in range(len(w) - length + 1):
            g, place = tuple(w[i:i + length]), (key(r), i)
            first[g] = min(first.get(g, place), place)
    out = []
    for r in rows:
        w = words(r[1])
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if (key(r), i) > first[tuple(w[i:i + length])]:
                gone[i:i + length] = [True] * length
        out.append((r[0], len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


def brute_bytes(rows, length):
    raws = [(r[1] or "").encode() for r in rows]
    seen = Counter(b[i:i + length] for b in raws for i in range(len(b) - length + 1))
    out = []
    for r, b in zip(rows, raws):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((r[0], len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("length,q", [(20, 8), (12, 5)])
def test_word_windows_match_brute_force(make_docs, length, q):
    rows = corpus(length)
    got = substring.remove_repeats(make_docs(rows), length=length, q=q).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == brute_words(rows, length)


def test_word_windows_carry_the_row(make_docs):
    rows = [(1, " ".join(map(str, range(30)))), (2, " ".join(map(str, range(30))))]
    got = {r.row.doc_id: r for r in substring.remove_repeats(make_docs(rows), carry=True).collect()}
    assert got[2].n_removed == 30 and got[2].kept == "" and got[2].row.d == "x" and got[2].row.n_words == 3
    assert got[1].n_removed == 0 and got[1].row.text == rows[0][1]


@pytest.mark.parametrize("length,q,bucket", [(60, 20, 2048), (60, 20, 2)])
def test_byte_strings_match_brute_force(make_docs, length, q, bucket):
    """A bucket limit of two drives the refinement across the cluster through all its depths."""
    rows = corpus(7, 25)
    got = suffix.remove_repeats(make_docs(rows), length=length, q=q, bucket=bucket).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got), key=str) \
        == brute_bytes(rows, length)


def test_empty_tables(make_docs):
    assert substring.digest(substring.remove_repeats(make_docs([]))).collect() == []
    assert suffix.digest(suffix.remove_repeats(make_docs([]))).collect() == []


def test_digest_is_of_the_kept_words(make_docs):
    rows = [(1, "a\tb  c"), (2, None)]
    got = {r.doc_id: r.kept_sha256 for r in substring.digest(substring.remove_repeats(make_docs(rows))).collect()}
    assert got == {1: hashlib.sha256(b"a b c").hexdigest(), 2: hashlib.sha256(b"").hexdigest()}


@pytest.mark.parametrize("seed", range(6))
def test_refinement_tells_all_strings_apart(seed):
    rnd = np.random.default_rng(seed)
    data = rnd.integers(97, 97 + 1 + seed % 3, 700, dtype=np.uint8)
    length = int(rnd.integers(3, 90))
    pointer = suffix.refine(data, length)
    raw = data.tobytes() + bytes(length)
    strings = [raw[i:i + length] for i in range(len(data))]
    order = sorted(range(len(data)), key=lambda i: strings[i])
    first = {}
    for rank, i in enumerate(order):
        first.setdefault(strings[i], rank)
    assert [first[s] for s in strings] == pointer.tolist()


def test_words_of_a_long_text_are_never_cut(monkeypatch):
    text = ("word " * 50 + "x" * 300 + " tail ").encode() * 20
    buf, off = np.frombuffer(b"a b" + text + b"c", np.uint8), np.array([0, 3, 3 + len(text), 4 + len(text)])
    whole = hashing.word_hashes(buf, off)
    monkeypatch.setattr(hashing, "PIECE", 64)
    cut = hashing.word_hashes(buf, off)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def test_long_texts_are_cut_into_overlapping_stretches(monkeypatch, make_docs):
    monkeypatch.setattr(hashing, "SEGMENT", 100)
    units = hashing.mix(np.arange(1000, dtype=np.uint64) % np.uint64(37))
    seen = set()
    for i, j, s, e in hashing.segments(np.array([0, 950, 1000]), 20, 100):
        _, first, n, *_ = hashing.anchor_runs(units[s:e], np.clip(np.array([0, 950, 1000])[i:j + 1] - s, 0, e - s), 20, 8)
        for a, k in zip(first, n):
            new = {s + a + x for x in range(k)}
            assert not new & seen
            seen |= new
    assert seen == {*range(931), *range(950, 981)}


@pytest.mark.parametrize("remove,name", [(substring.remove_repeats, "spans"), (suffix.remove_repeats, "found")])
def test_rows_that_repeat_a_document_multiply_nothing(spark, make_docs, monkeypatch, remove, name):
    """Each of them gets the spans of one text, and one of them is cut and sorted."""
    rnd = random.Random(9)
    draw = lambda n: [rnd.choice("abcdefghij") * 3 + str(rnd.randrange(10 ** 6)) for _ in range(n)]
    shared = draw(60)
    a, b, c = (" ".join(draw(40) + shared + draw(40)) for _ in range(3))
    rows = [(1, a)] + [(7, b)] * 30 + [(None, c)] * 30
    lists, pieces, kind = [], [], type(make_docs(rows))
    plain, staged = kind.mapInArrow, suffix.stage

    def spy(self, *args, **kw):
        if name in self.columns:
            lists.append(self.select(name))
        return plain(self, *args, **kw)

    def spy_stage(df, label):
        out = staged(df, label)
        if label == "byte-pieces":
            pieces.append(out)
        return out

    monkeypatch.setattr(kind, "mapInArrow", spy)
    monkeypatch.setattr(suffix, "stage", spy_stage)
    got = remove(make_docs(rows))
    if name == "spans":
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()), key=str) == brute_words(rows, 20)
    else:
        assert sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got.collect()),
                      key=str) == brute_bytes(rows, suffix.LENGTH)
    found = [[tuple(x) for x in r[0]] for df in lists for r in df.collect() if r[0]]
    assert found and all(len(x) == len(set(x)) for x in found)
    for p in pieces:
        assert p.count() == p.select("d", "f", "pos", "h", "c").distinct().count() > 0
