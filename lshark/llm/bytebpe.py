"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue (operator 3).

Pre-tokens are linked lists of parts, all those of a batch side by side in one
array.  Every adjacent pair with a merge rank waits in the bucket of its rank;
a two-level bitmap of wide words marks the filled buckets, so find-first-set on
two words gives the next rank whatever the length of the pre-tokens.  Entries
whose pair has changed meanwhile are skipped when met.  A merge costs a
constant number of queue operations, so a pre-token of a million bytes takes
time in proportion to its length.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lshark.llm.common import batch, id_back, in_task, keyed_texts, remembered, ship

UNITS, PIECES = 500_000, 500_000     # stretches and pre-tokens with remembered ids, per Python worker
LONGEST_CACHED = 64          # characters
MERGED = 4096                # pre-tokens merged side by side
TEXTS = 128                  # texts encoded together
BITS = 8                     # bitmap words of 256 bits: 50,000 ranks are 196 words under one top word
MASK = (1 << BITS) - 1
# Unicode white space as the rank files' splitting pattern means it
SPACE = r"\t-\r \x85\xa0  -     　"
_SPLIT_SAFELY = re.compile(r"(?<=\S) (?=\S)")
_UNSAFE = re.compile(r"\s\s|\A\s|\s\Z")


def _cut_anywhere(text: str) -> bool:
    """Whether every space stands between two characters that are no white
    space.  Where line ends are the only other white space, which printable
    texts without them tell, a few searches do."""
    if text.replace("\n", "x").isprintable():
        return not ("  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ")
    return _UNSAFE.search(text) is None


class RankQueue:
    """Positions by rank; gives up the bucket of the lowest rank."""

    def __init__(self, n_ranks: int):
        self.words = [0] * ((n_ranks >> BITS) + 1)     # a bit per filled bucket
        self.top = 0                                   # a bit per word with a bit
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, positions: list[int]) -> None:
        held = self.buckets.get(rank)
        if held is not None:
            held += positions
            return
        self.buckets[rank] = positions
        w = rank >> BITS
        low = self.words[w]
        if not low:
            self.top |= 1 << w
        self.words[w] = low | 1 << (rank & MASK)

    def pop(self) -> tuple[int, list[int]]:
        """Lowest rank and its positions, in order."""
        top = self.top
        w = (top & -top).bit_length() - 1
        low = self.words[w]
        rank = (w << BITS) + (low & -low).bit_length() - 1
        self.words[w] = low = low & (low - 1)
        if not low:
            self.top = top & (top - 1)
        held = self.buckets.pop(rank)
        held.sort()
        return rank, held


class ByteBPE:
    """Ranks of a byte-level vocabulary with the pattern that splits text."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.queue = RankQueue(len(self.bytes_of))
        # ranks of single bytes and of all pairs of bytes, -1 without one
        self.single = np.array([self.ranks[bytes([x])] for x in range(256)])
        self.double = np.full(1 << 16, -1)
        for token, rank in self.ranks.items():
            if len(token) == 2:
                self.double[token[0] << 8 | token[1]] = rank
        self.split = regex.compile(pattern.replace(r"[^\s", "[^" + SPACE).replace(r"\s", f"[{SPACE}]")
                                   .replace(r"\S", f"[^{SPACE}]"))
        self.decimal = [str(x) for x in range(len(self.bytes_of))]
        self.cache: dict[str, tuple[bytes, str, bytes]] = {}       # stretches by what follows their space
        self.pieces: dict[str, list[int]] = {}

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of pre-tokens, merged side by side."""
        data = b"".join(pieces)
        n, queue, get = len(data), self.queue, self.ranks.get
        buckets, push = queue.buckets, queue.push
        limits = np.cumsum([0, *map(len, pieces)])
        edge = bytearray(n + 1)                        # 1 where a piece starts or ends
        for x in limits.tolist():
            edge[x] = 1
        raw = np.frombuffer(data, np.uint8).astype(np.int64)
        token = self.single[raw].tolist()              # id of the part that starts here
        end = list(range(1, n + 1))                    # end of that part
        before = list(range(-1, n - 1))                # start of the part before
        first = np.full(n, -1)                         # rank of that part with the next, -1 without one
        first[:-1] = self.double[raw[:-1] << 8 | raw[1:]]
        first[limits[1:][limits[1:] > 0] - 1] = -1
        pair = first.tolist()
        order = np.argsort(first, kind="stable")
        order = order[np.searchsorted(first[order], 0):]
        cuts = np.flatnonzero(np.diff(first[order])) + 1
        for at in np.split(order, cuts) if len(order) else []:
            push(pair[at[0]], at.tolist())
        while queue.top:
            rank, waiting = queue.pop()
            for k, i in enumerate(waiting):
                if pair[i] != rank:
                    continue                           # stale
                right = end[i]
                stop = end[i] = end[right]
                token[i] = rank
                pair[right] = -1
                lower = False
                if edge[stop]:
                    pair[i] = -1
                else:
                    before[stop] = i
                    r = pair[i] = get(data[i:end[stop]], -1)
                    if r >= 0:
                        if r in buckets:
                            buckets[r].append(i)
                        else:
                            push(r, [i])
                        lower = r < rank
                if not edge[i]:
                    left = before[i]
                    r = get(data[left:stop], -1)
                    if pair[left] != r:
                        pair[left] = r
                        if r >= 0:
                            if r in buckets:
                                buckets[r].append(left)
                            else:
                                push(r, [left])
                            lower = lower or r < rank
                if lower and k + 1 < len(waiting):     # a lower rank came up: it goes first
                    push(rank, waiting[k + 1:])
                    break
        out = []
        for i, stop in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
            ids = []
            while i < stop:
                ids.append(token[i])
                i = end[i]
            out.append(ids)
        return out

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.merge([piece])[0]

    def decode(self, ids) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in ids])

    def _learn(self, units: set[str], space: str) -> dict[str, tuple[bytes, str, bytes]]:
        """Codes of stretches after ``space``; pre-tokens are merged together."""
        split, pieces, new = {}, self.pieces, set()
        for u in units:
            split[u] = found = self.split.findall(space + u)
            for p in found:
                if p not in pieces:
                    new.add(p)
        fresh, long = {}, []
        for p in new:
            raw = p.encode()
            whole = self.ranks.get(raw)
            if whole is None:
                long.append((p, raw))
            else:
                fresh[p] = [whole]
        for at in range(0, len(long), MERGED):
            part = long[at:at + MERGED]
            fresh.update(zip([p for p, _ in part], self.merge([raw for _, raw in part]), strict=True))
        out, decimal, table = {}, self.decimal, self.bytes_of
        for u, found in split.items():
            ids = [i for p in found for i in (fresh[p] if p in fresh else pieces[p])]
            out[u] = (array("I", ids).tobytes(), ",".join([decimal[i] for i in ids]), b"".join([table[i] for i in ids]))
        if len(pieces) < PIECES:
            pieces.update((p, ids) for p, ids in fresh.items() if len(p) <= LONGEST_CACHED)
        return out

    def encode(self, texts: list[str]) -> list[list[tuple[bytes, str, bytes]]]:
        """Per text its stretches, in order, as ``(ids as unsigned 32-bit bytes,
        decimal ids, decoded bytes)``.  A pre-token crosses no single space
        between two other characters, except that it may start with it; so
        texts are cut there and equal stretches are encoded once while they
        are remembered."""
        get, split, found, heads = self.cache.get, [], [], set()
        for text in texts:
            units = text.split(" ") if _cut_anywhere(text) else _SPLIT_SAFELY.split(text)
            heads.add(units[0])
            split.append(units)
            found.append(list(map(get, units[1:])))
        unknown = {u for units, got in zip(split, found, strict=True) if None in got
                   for u, g in zip(units[1:], got, strict=True) if g is None}
        if len(self.cache) >= UNITS and 2 * len(unknown) > sum(map(len, split)):
            self.cache.clear()                         # the texts have become others: start afresh
            self.pieces.clear()
        first, local = self._learn(heads, ""), self._learn(unknown, " ")
        if len(self.cache) < UNITS:
            self.cache.update((u, got) for u, got in local.items() if len(u) <= LONGEST_CACHED)
        return [[first[units[0]], *([local[u] if g is None else g for u, g in zip(units[1:], got, strict=True)]
                                    if None in got else got)] if units != [""] else []
                for units, got in zip(split, found, strict=True)]


def codec(path: str, pattern: str) -> ByteBPE:
    """The codec, remembered by the Python worker."""
    return remembered((path, pattern), lambda: ByteBPE(path, pattern))


def _coded(batch_texts, bpe: ByteBPE):
    texts = batch_texts.to_pylist()
    for at in range(0, len(texts), TEXTS):
        yield from bpe.encode(texts[at:at + TEXTS])


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>)`` of every whole text; null and empty texts have no ids.

    Null ids stay null, repeated rows are encoded each, an empty table gives
    an empty result; no other column is read.
    """
    def run(batches):
        bpe = codec(path, pattern)
        for b in batches:
            ids = [np.frombuffer(b"".join([x[0] for x in got]), "<u4").astype(np.int32)
                   for got in _coded(b.column("text"), bpe)]
            yield batch(["d", "ids"], [b.column("d"), pa.array(ids, pa.list_(pa.int32()))])

    ship(docs.sparkSession)
    texts = keyed_texts(docs, id_col, text_col).select("d", "text")
    out = texts.mapInArrow(in_task(run, (path, pattern)), "d long, ids array<int>")
    return out.withColumn("d", id_back(F.col("d"))).withColumnRenamed("d", id_col)


def decode(coded: DataFrame, path: str, pattern: str, ids_col: str = "ids", out_col: str = "bytes") -> DataFrame:
    """Adds the decoded bytes of an id column; null ids decode to nothing."""
    ship(coded.sparkSession)

    @F.pandas_udf("binary")
    def decoded(ids):
        bpe = codec(path, pattern)
        return ids.map(lambda x: b"" if x is None else bpe.decode(x))

    return coded.withColumn(out_col, decoded(F.col(ids_col)))


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of ids and decoded bytes without moving either through the JVM:
    ``(id, n_tokens, ids_sha256, decoded_sha256)``."""
    def run(batches):
        bpe = codec(path, pattern)
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for got in _coded(b.column("text"), bpe):
                n.append(sum([len(x[0]) for x in got]) // 4)
                ids_sha.append(hashlib.sha256(",".join([x[1] for x in got]).encode()).hexdigest())
                text_sha.append(hashlib.sha256(b"".join([x[2] for x in got])).hexdigest())
            yield batch(["d", "n_tokens", "ids_sha256", "decoded_sha256"],
                        [b.column("d"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                         pa.array(text_sha, pa.string())])

    ship(docs.sparkSession)
    texts = keyed_texts(docs, id_col, text_col).select("d", "text")
    out = texts.mapInArrow(in_task(run, (path, pattern)), "d long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumn("d", id_back(F.col("d"))).withColumnRenamed("d", id_col)
