"""Token pieces and packing."""

import random
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lshark.llm import packing
from lshark.llm.common import NULL_ID

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def pieces_of(tokenizer, doc_id, text, capacity=4096):
    ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
    return [(doc_id, k, s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes()))
            for k, s in enumerate(range(0, len(ids), capacity))]


def test_word_by_word_ids_equal_whole_text_ids(tokenizer):
    rnd = random.Random(3)
    alphabet = "ab 's'LL\t\n\r\x0b\x0c\x1c\x85\xa0 ​́̊AéÉΣſ1２!?<|endoftext|>漢🙂"
    for _ in range(3000):
        s = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40)))
        got = np.frombuffer(packing.token_ids([s.encode()], PATH)[0], "<u4").tolist()
        assert got == tokenizer.encode(s, add_special_tokens=False).ids + [1], repr(s)


def test_pieces_and_places(make_docs, tokenizer):
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice(["alpha", "beta!", "Gamma", "été", "x1"]) for _ in range(rnd.randrange(1, 900)))
             for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100, None), (101, ""), (None, "null id"), (102, "word " * 9000), (7, texts[7]), (103, "y" * 9000)]
    got = packing.pack_documents(make_docs(rows), PATH).collect()
    want = sorted((p for r in rows for p in pieces_of(tokenizer, *r[:2])), key=str)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 4096
    assert len(bins) <= -(-sum(r.length for r in got) // 4096) + 1


def test_empty_table(make_docs):
    assert packing.pack_documents(make_docs([]), PATH).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_local_search_keeps_items_and_never_adds_bins(seed):
    rnd = random.Random(seed)
    sizes = sorted((rnd.randrange(900, 3000) for _ in range(120)), reverse=True)
    start = packing.best_fit_decreasing(sizes, 4096)
    done = packing.local_search([list(b) for b in start], sizes, 4096)
    assert sorted(i for b in done for i in b) == list(range(120))
    assert all(sum(sizes[i] for i in b) <= 4096 for b in done) and len(done) <= len(start)


@pytest.mark.parametrize("start,size,bins", [
    ([[0], [1]], [6, 4], 1),                                  # move
    ([[0, 1], [2], [3]], [5, 4, 6, 5], 2),                    # one for one: 5 <-> 6, then 4 + 6 and 5 + 5
    ([[0, 1, 2], [3, 4], [5]], [3, 3, 3, 7, 2, 2], 2),        # smaller bins empty into fuller ones
])
def test_exchanges_empty_bins(start, size, bins):
    assert len(packing.local_search(start, size, 10)) == bins


def test_groups_are_packed_again(spark):
    rnd = random.Random(5)
    rows = [(i, 0, 0, rnd.randrange(500, 2500), 0) for i in range(600)]
    pieces = spark.createDataFrame(rows, "d long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack_pieces(pieces, group=60).collect()
    assert sorted(r.d for r in got) == list(range(600))
    fill = {}
    for r in got:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 4096 and len(fill) <= 1.03 * sum(fill.values()) / 4096 + 1


def test_rows_that_repeat_an_id_are_spread_over_groups(spark):
    rows = [(NULL_ID if i % 3 else 5, 0, 0, 2048, i) for i in range(1200)]
    pieces = spark.createDataFrame(rows, "d long, piece int, start long, length long, ids_crc32 long").repartition(4)
    got = packing.pack_pieces(pieces, group=100).collect()
    assert sorted(r.ids_crc32 for r in got) == list(range(1200))
    groups = {}
    for r in got:
        groups[r.sequence_id >> 20] = groups.get(r.sequence_id >> 20, 0) + 1
    assert len(groups) >= 12 and max(groups.values()) < 200
    assert len({(r.sequence_id, r.offset) for r in got}) == 1200 and {r.offset for r in got} == {0, 2048}


def test_added_tokens_in_texts_are_those_of_the_untouched_tokenizer():
    plain, rnd = Tokenizer.from_file(PATH), random.Random(8)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", "endoftext", "ab", "É", "1", "'s", "́", " ", "\n"]
    texts = ["a <|endoftext|> b", "x<|endoftext|>y"] + ["".join(rnd.choices(parts, k=rnd.randrange(12))) for _ in range(1500)]
    for s, ids in zip(texts, packing.token_ids([t.encode() for t in texts], PATH), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(s, add_special_tokens=False).ids + [1], repr(s)


def test_parts_of_plain_words_are_encoded_together(monkeypatch):
    """Ids stay those of the whole text, though hundreds of words go to the tokenizer as one."""
    own, texts = [], []
    words = packing.WordTokenizer(PATH)

    class Spy:
        def __init__(self, inner):
            self.inner = inner

        def encode(self, text, **kw):
            own.append(text)
            return self.inner.encode(text, **kw)

        def encode_batch_fast(self, some, **kw):
            own.extend(some)
            return self.inner.encode_batch_fast(some, **kw)

    words.tokenizer = Spy(words.tokenizer)
    rnd = random.Random(3)
    plain = ["".join(rnd.choices("abcXYZ\u00e9\u00df\u00c4", k=rnd.randint(1, 60))) + rnd.choice(["", ".", "!!", "-x"])
             for _ in range(900)]
    odd = ["it's", "4x4", "\u0130x", "<|endoftext|>y", "\u03a3\u03a3", "e\u0301", "\u4e2d"]
    for lo in range(0, len(plain), 300):
        texts.append(" ".join(plain[lo:lo + 300] + odd))
    want = [Tokenizer.from_file(PATH).encode(t, add_special_tokens=False).ids + [1] for t in texts]
    raw = [t.encode() for t in texts]
    assert [list(array("I", x)) for x in words.encode(raw, 1)] == want
    assert len(own) < 50
    assert max(map(len, words.words)) <= packing.LONGEST_CACHED
    monkeypatch.setattr(packing, "WORDS", 0)                  # nothing more is remembered
    held = len(words.words)
    assert [list(array("I", x)) for x in words.encode([b"new words here"] + raw, 1)][1:] == want
    assert len(words.words) <= held
