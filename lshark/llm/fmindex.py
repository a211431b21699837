"""Benchmark decontamination with an FM-index per training shard (operator 12).

A *phrase* is a window of ``length`` consecutive words of a benchmark item (the
whole item where it has fewer).  Every task gathers its documents into shards
and indexes the words of each shard:

* words become numbers of the benchmark's vocabulary.  A word outside it can be
  in no phrase, so it only separates; stretches shorter than the shortest
  phrase cannot hold one and are left out;
* suffixes are sorted by doubling (a stretch that ends sorts first, equal ones
  by place), which gives the Burrows-Wheeler transform in a wavelet matrix;
* all phrases are searched backwards together, two rank queries a word, and
  are dropped as soon as their interval is empty;
* occurrences are located by walking to the next sampled suffix;
* their word ranges are merged per document.

Documents pass through one map step: nothing is shuffled.  The phrases are
broadcast in blocks of at most ``BLOCK_BYTES`` of benchmark text; a larger
benchmark takes one pass for each block, between which the findings are written.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lshark.llm import hashing
from lshark.llm.common import in_task, ship, stage, text_bytes
from lshark.llm.hashing import U

LENGTH = 10
SHARD_BYTES = 16 << 20         # text of a shard; a longer text is a shard of its own
BLOCK_BYTES = 32 << 20         # benchmark text broadcast at once
SAMPLE = 8                     # every so many places a suffix position is kept
FILTER_BITS = 20

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
# fixed values: the bytes that words are made of, [^\x00-\x2F\x3A-\x60\x7B-\x7F], after lower-casing
_word = np.zeros(256, bool)
_word[0x30:0x3A] = _word[0x61:0x7B] = _word[0x80:] = True


def _cut(buf: np.ndarray, off: np.ndarray, e: int) -> int:
    """The first place from ``e`` on that is outside a word or starts a text."""
    limit = int(off[min(np.searchsorted(off, e), len(off) - 1)])
    while e < limit:
        gap = np.flatnonzero(~_word[_lower[buf[e:min(e + 4096, limit)]]])
        if len(gap):
            return e + int(gap[0])
        e += 4096
    return limit


def word_hashes(buf: np.ndarray, off: np.ndarray, piece: int = hashing.PIECE) -> tuple[np.ndarray, np.ndarray]:
    """``(hash of every word, word offsets per text)`` of lower-cased texts,
    read about a megabyte at a time and never cut inside a word."""
    s, hashes, places = 0, [], []
    while s < len(buf):
        e = _cut(buf, off, s + piece)
        low = _lower[buf[s:e]]
        is_word = _word[low]
        edge = off[np.searchsorted(off, s):np.searchsorted(off, e)] - s
        start, stop = is_word.copy(), is_word.copy()
        start[1:] &= ~is_word[:-1]
        start[edge] |= is_word[edge]
        stop[:-1] &= ~is_word[1:]
        last = edge[edge > 0] - 1
        stop[last] |= is_word[last]
        first = np.flatnonzero(start)
        if len(first):
            hashes.append(hashing.Prefix(hashing.byte_table()[low]).ranges(first, np.flatnonzero(stop) + 1))
            places.append(first + s)
        s = e
    if not hashes:
        return np.empty(0, U), np.zeros(len(off), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), off)


# ------------------------------------------------------------------ phrases

@dataclass
class Phrases:
    """Distinct phrases of a block of items: ``words`` (sorted hashes; number
    ``k`` is symbol ``k + 1``), ``grid`` (phrases, right-aligned, 0 before their
    first symbol), ``size`` of each, and the items of each phrase."""

    words: np.ndarray
    grid: np.ndarray
    size: np.ndarray
    item_off: np.ndarray
    items: list[str]
    shortest: int = field(init=False)
    likely: np.ndarray = field(init=False)

    def __post_init__(self):
        self.shortest = int(self.size.min()) if len(self.size) else 0
        self.likely = np.zeros(1 << FILTER_BITS, bool)
        self.likely[(self.words & U((1 << FILTER_BITS) - 1)).astype(np.int64)] = True

    def symbols(self, h: np.ndarray) -> np.ndarray:
        """Number of each word, 0 outside the vocabulary."""
        out = np.zeros(len(h), np.int64)
        near = np.flatnonzero(self.likely[(h & U((1 << FILTER_BITS) - 1)).astype(np.int64)])
        at = np.searchsorted(self.words, h[near])
        at[at == len(self.words)] = 0
        out[near] = np.where(self.words[at] == h[near], at + 1, 0)
        return out


def phrases(items: list[tuple[str, bytes]], length: int = LENGTH) -> Phrases | None:
    """The phrases of ``(item, text)`` pairs; None without a word."""
    off = np.concatenate(([0], np.cumsum([len(t) for _, t in items]))).astype(np.int64)
    h, woff = word_hashes(np.frombuffer(b"".join(t for _, t in items), np.uint8), off)
    if not len(h):
        return None
    words, sym = np.unique(h, return_inverse=True)
    sym = sym.astype(np.int64) + 1
    n = np.diff(woff)
    count = np.where(n >= length, n - length + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(items)), count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + woff[:-1][owner]
    size = np.minimum(n, length)[owner]
    at = start[:, None] + size[:, None] - length + np.arange(length)[None, :]
    grid = np.where(at >= start[:, None], sym[np.maximum(at, 0)], 0)
    grid, which = np.unique(grid, axis=0, return_inverse=True)
    pair = np.unique(np.stack([which.ravel(), owner], 1), axis=0)
    return Phrases(words, grid, (grid > 0).sum(1), np.searchsorted(pair[:, 0], np.arange(len(grid) + 1)),
                   [items[k][0] for k in pair[:, 1]])


# ------------------------------------------------------------------ the index

def suffix_order(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Order of all suffixes of the stretches in ``text``; ``left`` counts the
    symbols to the end of a suffix's stretch.  A suffix that another one goes
    on from sorts before it, equal suffixes by place."""
    n, depth = len(text), 1
    order = np.argsort(text, kind="stable")
    same = np.zeros(n, bool)
    same[1:] = text[order[1:]] == text[order[:-1]]
    start = np.flatnonzero(~same)
    rank = np.empty(n, np.int64)                       # place of the first suffix of its group, plus one
    rank[order] = np.repeat(start, np.diff(np.append(start, n))) + 1
    while same.any():
        tied = same.copy()
        tied[:-1] |= same[1:]
        at = np.flatnonzero(tied)                      # only groups still tied are sorted again
        who = order[at]
        going = left[who] > depth
        key = rank[who] * np.int64(n + 1) + np.where(going, rank[np.minimum(who + depth, n - 1)], 0)
        o = np.argsort(key, kind="stable")
        who, key, going = who[o], key[o], going[o]
        new = ~going                                   # ended suffixes are in order, by place
        new[0] = True
        new[1:] |= key[1:] != key[:-1]
        first = np.flatnonzero(new)
        order[at], same[at] = who, ~new
        rank[who] = np.repeat(at[first], np.diff(np.append(first, len(at)))) + 1
        depth *= 2
    return order


class Bits:
    """A bit string with rank queries: counts before every 64-bit word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.w = np.packbits(padded, bitorder="little").view(U)
        self.c = np.concatenate(([0], np.cumsum(np.bitwise_count(self.w).astype(np.int64))))
        self.zeros = len(bits) - int(self.c[-1])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits before place ``i``."""
        k = i >> 6
        part = self.w[np.minimum(k, len(self.w) - 1)] & ((U(1) << (i & 63).astype(U)) - U(1))
        return self.c[k] + np.bitwise_count(part).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.w[i >> 6] >> (i & 63).astype(U)) & U(1) == 1


class Wavelet:
    """Wavelet matrix of a sequence of symbols below ``1 << depth``."""

    def __init__(self, seq: np.ndarray, depth: int):
        self.levels, self.depth = [], depth
        for k in range(depth - 1, -1, -1):
            bit = (seq >> k) & 1
            self.levels.append(Bits(bit.astype(np.uint8)))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before place ``i``, elementwise."""
        lo = np.zeros(len(i), np.int64)
        for k, b in zip(range(self.depth - 1, -1, -1), self.levels, strict=True):
            one = (symbol >> k) & 1 == 1
            a, c = b.ones(lo), b.ones(i)
            lo, i = np.where(one, b.zeros + a, lo - a), np.where(one, b.zeros + c, i - c)
        return i - lo

    def get(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(symbol, its rank)`` at place ``i``."""
        symbol, start = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        for b in self.levels:
            one = b.get(i)
            a, c = b.ones(start), b.ones(i)
            start, i = np.where(one, b.zeros + a, start - a), np.where(one, b.zeros + c, i - c)
            symbol = symbol * 2 + one
        return symbol, i - start


class FMIndex:
    """Index of stretches of symbols ``text`` (positive), laid end to end;
    ``left`` counts the words to the end of each stretch."""

    def __init__(self, text: np.ndarray, left: np.ndarray):
        n = len(text)
        order = suffix_order(text, left)
        first = np.ones(n, bool)
        first[1:] = left[:-1] == 1
        # what precedes each suffix; 0 before a stretch, where no search goes on
        before = np.where(first[order], 0, text[order - 1])
        self.total = np.bincount(text)
        self.base = np.concatenate(([0], np.cumsum(self.total)))
        # the last symbols of stretches come first among their like, and precede no suffix
        self.after = self.base[:-1] + np.bincount(text[left == 1], minlength=len(self.total))
        self.seq = Wavelet(before, int(text.max()).bit_length())
        # a suffix is sampled every SAMPLE places of a stretch, at its start first
        place = np.arange(n)
        from_start = place - np.maximum.accumulate(np.where(first, place, 0))
        mark = from_start[order] % SAMPLE == 0
        self.marks, self.sampled = Bits(mark.astype(np.uint8)), order[mark]

    def find(self, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(phrase, place)`` of every occurrence of the phrases of ``grid``."""
        who = np.arange(len(grid))
        lo = hi = None
        for k in range(grid.shape[1] - 1, -1, -1):
            c = grid[who, k]
            known = c < len(self.total)
            if lo is None:
                ok = known & (self.total[np.where(known, c, 0)] > 0)
                who, c = who[ok], c[ok]
                lo, hi = self.base[c], self.base[c + 1]
                continue
            on = c > 0                                        # shorter phrases are done
            c = np.where(known & on, c, 0)
            a, b = self.after[c] + self.seq.rank(c, lo), self.after[c] + self.seq.rank(c, hi)
            lo, hi = np.where(on, a, lo), np.where(on, np.where(known, b, a), hi)
            ok = hi > lo
            who, lo, hi = who[ok], lo[ok], hi[ok]
            if not len(who):
                break
        n = hi - lo
        rows = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
        return np.repeat(who, n), self.locate(rows)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Place of the suffix in each row."""
        place, step = np.zeros(len(rows), np.int64), 0
        on = np.arange(len(rows))
        while len(on):
            hit = self.marks.get(rows)
            place[on[hit]] = self.sampled[self.marks.ones(rows[hit])] + step
            on, rows = on[~hit], rows[~hit]
            c, r = self.seq.get(rows)
            rows, step = self.after[c] + r, step + 1
        return place


def occurrences(h: np.ndarray, off: np.ndarray, known: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """``(phrase, word place)`` of the phrases in the words ``h`` of a shard;
    no occurrence crosses an offset."""
    sym = known.symbols(h)
    n = len(sym)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begin = sym > 0
    begin[1:] &= sym[:-1] == 0
    inner = off[(off > 0) & (off < n)]
    begin[inner] |= sym[inner] > 0
    start = np.flatnonzero(begin)
    stop = np.concatenate((start[1:], [n]))
    gap = np.append(np.flatnonzero(sym == 0), n)
    if len(start):
        stop = np.minimum(stop, gap[np.searchsorted(gap, start)])
    long = stop - start >= known.shortest
    start, size = start[long], (stop - start)[long]
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ends = np.cumsum(size)
    place = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
    left = np.repeat(ends, size) - np.arange(ends[-1])
    who, at = FMIndex(sym[place], left).find(known.grid)
    return who, place[at]


def merge(spans: np.ndarray) -> np.ndarray:
    """Union of ranges ``[start, end)``, as disjoint rising rows."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), bool)
    new[1:] = spans[1:, 0] > reach[:-1]
    first = np.flatnonzero(new)
    return np.stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]], 1)


def search(h: np.ndarray, off: np.ndarray, known: Phrases) -> dict[int, tuple[np.ndarray, list[str]]]:
    """Per text with an occurrence: merged word ranges, and the items."""
    who, at = occurrences(h, off, known)
    text = np.searchsorted(off, at, "right") - 1
    order = np.argsort(text, kind="stable")
    who, at, text = who[order], at[order], text[order]
    out, memo = {}, {}
    cut = np.flatnonzero(np.diff(text, prepend=-1)) if len(text) else []
    for s, e in zip(cut, np.append(cut[1:], len(text)), strict=True) if len(text) else []:
        t = int(text[s])
        mine = np.unique(who[s:e])
        key = mine.tobytes()
        if key not in memo:                                   # copies hold the same phrases
            memo[key] = sorted({known.items[k] for p in mine
                                for k in range(known.item_off[p], known.item_off[p + 1])})
        spans = np.stack([at[s:e], at[s:e] + known.size[who[s:e]]], 1) - off[t]
        out[t] = merge(spans), memo[key]
    return out


# ------------------------------------------------------------------ the operator

def _pass(docs: DataFrame, known, text_col: str, out: list[str]) -> DataFrame:
    """One block of phrases over all documents, returning the columns ``out``;
    ``known`` is its broadcast."""
    def finish(held: list[pa.RecordBatch]):
        b = pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]
        buf, off = text_bytes(b.column("row").field(text_col) if "row" in b.schema.names else b.column("text"))
        h, woff = word_hashes(buf, off)
        found = search(h, woff, known.value) if known.value is not None else {}
        spans, items = b.column("spans").to_pylist(), b.column("items").to_pylist()
        for t, (ranges, names) in found.items():
            old = np.array([[x["s"], x["e"]] for x in spans[t]], np.int64).reshape(-1, 2)
            spans[t] = [{"s": s, "e": e} for s, e in merge(np.concatenate((old, ranges))).tolist()]
            items[t] = sorted({*items[t], *names}) if items[t] else names
        new = {"n_words": pa.array(np.diff(woff)), "spans": pa.array(spans, b.schema.field("spans").type),
               "items": pa.array(items, pa.list_(pa.string()))}
        return pa.RecordBatch.from_arrays([new[c] if c in new else b.column(c) for c in out], names=out)

    def run(batches):
        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            n = b.nbytes
            if held and size + n > SHARD_BYTES:
                yield finish(held)
                held, size = [], 0
            held.append(b)
            size += n
        if held:
            yield finish(held)

    return docs.mapInArrow(in_task(run), docs.select(*out).schema)


def blocks(bench: DataFrame, id_col: str, text_col: str, size: int) -> list[DataFrame]:
    """The items with text, cut into parts of about ``size`` bytes by a hash of the id."""
    items = bench.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).where(
        "item IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    n = -(-total // size)
    part = F.pmod(F.xxhash64("item", "text"), F.lit(max(n, 1)))
    return [items.where(part == k) for k in range(n)]


def decontaminate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", length: int = LENGTH, carry: bool = False,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Benchmark passages in every document: ``(id, n_words, spans, items)``;
    with ``carry`` also ``row``, the input row as a struct.

    ``spans`` are disjoint rising ranges of words ``s`` to ``e`` (exclusive) to
    remove, ``items`` the sorted ids, as strings, of the items found.  Null and
    empty texts have no words; items without a word, a text or an id match
    nothing; rows that repeat an item id are one item.  Null and repeated
    document ids are rows like others.  An empty benchmark finds nothing, an
    empty document table gives an empty result.  Words are told apart by 64
    bits of hash.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    now = docs.select(F.col(id_col).alias("id"), *([F.struct("*").alias("row")] if carry else [text]),
                      F.lit(0).cast("bigint").alias("n_words"),
                      F.array().cast("array<struct<s:bigint,e:bigint>>").alias("spans"),
                      F.array().cast("array<string>").alias("items"))
    parts = blocks(bench, item_col, "text", block_bytes)
    for k, part in enumerate(parts or [None]):
        rows = [] if part is None else [(r["item"], r["text"].encode()) for r in part.collect()]
        last = k + 1 >= len(parts)
        now = _pass(now, spark.sparkContext.broadcast(phrases(rows, length)), text_col,
                    [c for c in now.columns if c != "text" or not last])
        now = now if last else stage(now, "decontaminated")
    return now.select(F.col("id").alias(id_col), "n_words", "spans", "items", *(["row"] if carry else []))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["e"] - x["s"])
    return found.select(id_col, "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))
