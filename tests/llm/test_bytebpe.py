"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random
import time

import public_tokenizers
import pytest
import tiktoken

from lshark.llm import bytebpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bytebpe.codec(PATH, public_tokenizers.PATTERN)


def ids_of(codec, text):
    return [int(x) for got in codec.encode([text])[0] for x in got[1].split(",") if x]


def test_any_text_as_the_library_encodes_it(codec, library):
    rnd = random.Random(1)
    alphabet = "ab 's'll'tRE  \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 ᠎    　​123é漢!?.٣ⅷ🙂́ß"
    for _ in range(4000):
        s = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40)))
        assert ids_of(codec, s) == library.encode_ordinary(s), repr(s)
        assert b"".join(x[2] for x in codec.encode([s])[0]) == s.encode()


def test_ties_and_long_pre_tokens(codec, library):
    rnd = random.Random(2)
    for s in ("a" * 3001, "ab" * 2000, "aab" * 1500, "".join(rnd.choice("etaoin") for _ in range(20000))):
        assert ids_of(codec, s) == library.encode_ordinary(s)
    begin = time.time()
    codec.encode_piece(b"etaoinshrdlu" * 30000)
    assert time.time() - begin < 20


def test_rank_queue_gives_lowest_rank_with_positions_in_order():
    rnd, q, want = random.Random(3), bytebpe.RankQueue(50000), {}
    for _ in range(3000):
        rank, pos = rnd.randrange(2000) * 25, rnd.randrange(100)
        want.setdefault(rank, []).append(pos)
        q.push(rank, [pos])
    got = []
    while q.top:
        got.append(q.pop())
    assert got == [(r, sorted(p)) for r, p in sorted(want.items())]


def test_pieces_merged_side_by_side_do_not_meet(codec):
    rnd = random.Random(4)
    pieces = ["".join(rnd.choice("theanodris ") for _ in range(rnd.randrange(1, 14))).strip() or "a" for _ in range(3000)]
    joined = codec.merge([p.encode() for p in pieces])
    assert joined == [codec.merge([p.encode()])[0] for p in pieces]


def test_table(make_docs, library):
    rows = [(1, "Hello  wörld's"), (2, None), (3, ""), (None, " a"), (1, "Hello  wörld's"), (4, "long " * 3000)]
    docs = make_docs(rows)
    want = sorted(((d, len(i := library.encode_ordinary(t or "")), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
                    hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows), key=str)
    got = bytebpe.round_trip(docs, PATH, public_tokenizers.PATTERN).collect()
    assert sorted(map(tuple, got), key=str) == want
    coded = bytebpe.encode(docs, PATH, public_tokenizers.PATTERN)
    back = bytebpe.decode(coded, PATH, public_tokenizers.PATTERN).collect()
    assert sorted(((r.doc_id, list(r.ids), bytes(r.bytes)) for r in back), key=str) == sorted(
        ((d, library.encode_ordinary(t or ""), (t or "").encode()) for d, t in rows), key=str)
    assert bytebpe.round_trip(make_docs([]), PATH, public_tokenizers.PATTERN).collect() == []
