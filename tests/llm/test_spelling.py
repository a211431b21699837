import random
import re
import zlib
from collections import Counter

import pytest

from lshark.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows, shortest=5, fewest=3):
    count = Counter()
    for doc, text, *_ in rows:
        for w in RUN.findall(text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            count[w] += 1
    words = {w: n for w, n in count.items() if len(w) >= shortest and n >= fewest}
    form, out = {}, []
    for w, n in words.items():
        close = [x for x in words if near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
        out.append([w, form[w], None, n, len(close), words[form[w]] if form[w] else None])
    for row in out:
        end = row[0]
        while form[end] is not None:
            end = form[end]
        row[2] = end
    return sorted(map(tuple, out), key=str)


def found(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=str)


def corpus(seed, alphabet="abé", words=400):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choices(alphabet, k=rnd.randint(4, 8))) for _ in range(words)]
    rows = []
    for doc in range(120):
        picked = rnd.choices(pool, weights=[1 / (k + 1) for k in range(words)], k=rnd.randint(0, 60))
        rows.append((doc, rnd.choice([" ", ", ", "中", "1", "·"]).join(
            w.upper() if rnd.random() < 0.1 else w for w in picked)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_neighbours_match_brute_force(make_docs, seed):
    """Words of three letters: long runs of one letter, hot words, chains of forms."""
    rows = corpus(seed)
    assert found(spelling.variants(make_docs(rows))) == brute(rows)


def test_edge_rows(make_docs):
    rows = [(None, "words words words Words Àwords"), (1, None), (2, ""), (2, "wordz wordz wordz"), (2, "wordz wordz wordz"),
            (3, "x" * 5000 + " " + "x" * 4999), (4, "x" * 5000 + " " + "x" * 4999), (5, ("x" * 5000 + " " + "x" * 4999 + " ") * 2),
            (6, "中文 naïve nałve ÷×÷×÷ ÷×÷×÷ ÷×÷×÷ tail" * 3)]
    assert found(spelling.variants(make_docs(rows))) == brute(rows)


def test_empty_table(make_docs):
    assert spelling.variants(make_docs([])).collect() == []
    assert spelling.variants(make_docs([(1, "few words only")])).collect() == []


def test_long_texts_are_cut_between_runs(monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 7)
    text = "Some words, Été and more中文of them, longerthanapiece! end"
    whole = [w.translate(LOWER).encode() for w in RUN.findall(text)]
    assert [w for part in spelling.runs(text) for w in part] == whole


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_trie_numbers_are_equal_for_equal_prefixes_only(spark, parts):
    rnd = random.Random(parts)
    words = sorted({"".join(rnd.choices("abc", k=rnd.randint(1, 9))) for _ in range(500)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        for backward in (False, True):
            seen, back = {}, {}
            for r in spelling.trie(df, backward, "t").collect():
                w = r.word[::-1] if backward else r.word
                assert len(r.nodes) == len(w) + 1
                for k, node in enumerate(r.nodes):
                    assert seen.setdefault(w[:k], node) == node and back.setdefault(node, w[:k]) == w[:k]
            if not backward:
                assert sorted(words, key=lambda w: seen[w]) == words
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_long_chains_end_at_their_root(spark):
    step = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 40), (101, 40)], "id long, to long")
    assert {r.id: r.root for r in spelling.roots(step).collect()} == dict.fromkeys([*range(40), 100, 101], 40)
