"""Token pieces and their packing into fixed-length sequences (operator 2).

Documents are tokenised in Arrow batches; texts longer than a sequence are cut.
Pieces are dealt into groups of bounded size.  Each group is packed best-fit
decreasing and then improved by local search: documents are moved or exchanged
one-for-one, two-for-one and one-for-two between underfull bins wherever this
raises the sum of squared fills, until bins run empty.  What stays underfull
in all groups is dealt and packed a second time, so the loss does not grow
with the number of groups.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lshark.llm.common import batch, id_back, in_task, keyed_texts, remembered, ship, stage, text_bytes

CAPACITY = 4096
END_ID = 1
GROUP = 2000                 # pieces packed together by one task
UNDERFULL = 64               # free tokens from which a bin is packed again
WORDS, PARTS = 1_000_000, 800_000     # remembered at most by a Python worker
LONGEST_CACHED = 48          # bytes
TOGETHER = 256               # parts of words encoded as one text

#: Words of these characters fall apart into letters and marks that the
#: vocabulary's splitting pattern also keeps apart, and lower-casing them is
#: one character at a time.  Apostrophes and digits are left to the tokenizer.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ!-&(-/:-@\[-`{-~]+")
_PARTS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[!-&(-/:-@\[-`{-~]+")


class WordTokenizer:
    """Ids of texts word by word.  The vocabulary's pre-tokens never cross ASCII
    white space, which it drops, so a text's ids are those of its words in
    order; words and their parts are encoded by the tokenizer once while they
    are remembered.  Words that hold the text of an added token are not split."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _coded(self, plain: list[str], others: list[str]) -> dict[str, bytes]:
        """Ids of parts of plain words and of other words.  A part of a plain word
        is one pre-token, so many are encoded at once and told apart by it."""
        out = {}
        for lo in range(0, len(plain), TOGETHER):
            some = plain[lo:lo + TOGETHER]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids, of = np.array(found.ids, np.uint32), np.array(found.word_ids, np.int64)
            first = np.flatnonzero(np.diff(of, prepend=-1))
            if np.array_equal(of[first], np.arange(len(some))):
                ids, ends = ids.tobytes(), (4 * np.append(first, len(of))).tolist()
                out.update(zip(some, map(ids.__getitem__, map(slice, ends, ends[1:])), strict=True))
            else:
                others = others + some
        coded = self.tokenizer.encode_batch_fast(others, add_special_tokens=False) if others else []
        out.update((p, array("I", x.ids).tobytes()) for p, x in zip(others, coded, strict=True))
        return out

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words that are not remembered."""
        known, texts = self.parts, b"\n".join(words).decode().split("\n")
        low = "\n".join(texts).lower()
        special, low = any(a in low for a in self.added), low.split("\n")
        parts, plain, others = [], set(), set()
        for text, lower in zip(texts, low, strict=True):
            if text.isascii() and text.isalpha():  # one part
                parts.append([lower])
                if lower not in known:
                    plain.add(lower)
                continue
            apart = _PLAIN.fullmatch(text) and not (special and any(a in lower for a in self.added))
            parts.append(found := _PARTS.findall(lower) if apart else [text])
            for p in found:
                if p not in known:
                    (plain if apart else others).add(p)
        fresh = self._coded(list(plain), list(others - plain))
        if len(known) < PARTS:
            known.update(fresh)
            ids_of = known.__getitem__
        else:
            ids_of = lambda p: fresh[p] if p in fresh else known[p]
        out = {w: ids_of(found[0]) if len(found) == 1 else b"".join(map(ids_of, found))
               for w, found in zip(words, parts, strict=True)}
        for p in [p for p in fresh if len(p) > LONGEST_CACHED]:
            known.pop(p, None)
        return out

    def encode(self, texts: list[bytes], end_id: int) -> list[bytes]:
        """Ids of each text and ``end_id``, as unsigned 32-bit bytes."""
        words, end = self.words, array("I", [end_id]).tobytes()
        split = [t.split() for t in texts]
        unknown = list(set().union(*split).difference(words))
        if len(words) >= WORDS and 2 * len(unknown) > sum(map(len, split)):
            words.clear()                          # the texts have become others: start afresh
            self.parts.clear()
            unknown = list(set().union(*split))
        full = len(words) >= WORDS
        if unknown:
            words.update(self._learn(unknown))
        out = [b"".join(map(words.__getitem__, ws)) + end for ws in split]
        for w in unknown:
            if full or len(w) > LONGEST_CACHED:
                del words[w]
        return out


def token_ids(texts: list[bytes], path: str, end_id: int = END_ID) -> list[bytes]:
    """Ids of each text and ``end_id``; words are remembered by the Python worker."""
    return remembered(path, lambda: WordTokenizer(path)).encode(texts, end_id)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(d, piece, start, length, ids_crc32)``; only a text of more than
    ``capacity`` ids is cut, the last piece may be shorter."""
    step = 64

    def run(batches):
        for b in batches:
            buf, off = text_bytes(b.column("text"))
            d, out = b.column("d").to_pylist(), []
            for lo in range(0, len(d), step):
                texts = [buf[off[i]:off[i + 1]].tobytes() for i in range(lo, min(lo + step, len(d)))]
                for key, ids in zip(d[lo:lo + step], token_ids(texts, tokenizer, end_id), strict=True):
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at:at + 4 * capacity]
                        out.append((key, k, at // 4, len(part) // 4, zlib.crc32(part)))
            if out:
                key, k, at, n, crc = zip(*out, strict=True)
                yield batch(["d", "piece", "start", "length", "ids_crc32"],
                            [pa.array(key, pa.int64()), pa.array(k, pa.int32()), pa.array(at, pa.int64()),
                             pa.array(n, pa.int64()), pa.array(crc, pa.int64())])

    texts = keyed_texts(docs, id_col, text_col).select("d", "text")
    return texts.mapInArrow(in_task(run, tokenizer), "d long, piece int, start long, length long, ids_crc32 long")


# ------------------------------------------------------------ packing of one group


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices; ``lengths`` is in decreasing order."""
    bins: list[list[int]] = []
    free: list[tuple[int, int]] = []              # (free, bin), sorted
    for i, n in enumerate(lengths):
        k = bisect_left(free, (n, -1))
        if k < len(free):
            room, b = free.pop(k)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if room > n:
            insort(free, (room - n, b))
    return bins


def _best_exchange(give: list[int], take: list[int], size: list[int], room: int):
    """The exchange that moves most tokens, up to ``room``, from the emptier
    bin ``give`` into ``take``: ``(tokens, out of give, out of take)``."""
    best, choice = 0, None

    def consider(gain, out, back):
        nonlocal best, choice
        if best < gain <= room:
            best, choice = gain, (out, back)

    for x in give:
        consider(size[x], (x,), ())
        for y in take:
            consider(size[x] - size[y], (x,), (y,))
        for i, y in enumerate(take):
            for z in take[i + 1:]:
                consider(size[x] - size[y] - size[z], (x,), (y, z))
    for i, x in enumerate(give):
        for w in give[i + 1:]:
            for y in take:
                consider(size[x] + size[w] - size[y], (x, w), (y,))
    return best, choice


def local_search(bins: list[list[int]], size: list[int], capacity: int) -> list[list[int]]:
    """Exchanges between underfull bins that raise the sum of squared fills.

    Tokens only go from an emptier to a fuller bin, so the sum rises strictly
    and the search ends.  It stops early at the least possible number of bins.
    """
    least = -(-sum(size[i] for b in bins for i in b) // capacity)
    fill = [sum(size[i] for i in b) for b in bins]
    order = sorted((k for k in range(len(bins)) if fill[k] < capacity), key=lambda k: fill[k])
    alive, changed = len(bins), True
    while changed and alive > least:
        changed = False
        for j in order:
            if alive <= least:
                break
            for i in reversed(order):
                if not bins[j]:
                    break
                if i == j or not bins[i] or fill[i] < fill[j] or fill[i] == capacity:
                    continue
                gain, choice = _best_exchange(bins[j], bins[i], size, capacity - fill[i])
                if choice:
                    out, back = choice
                    bins[j] = [x for x in bins[j] if x not in out] + list(back)
                    bins[i] = [x for x in bins[i] if x not in back] + list(out)
                    fill[j] -= gain
                    fill[i] += gain
                    changed = True
            if not bins[j]:
                alive -= 1
        order = sorted((k for k in order if bins[k] and fill[k] < capacity), key=lambda k: fill[k])
    return [b for b in bins if b]


def pack_group(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices into ``lengths``, which is in decreasing order."""
    return local_search(best_fit_decreasing(lengths, capacity), lengths, capacity)


PACKED = "d long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, free long"


def _packer(capacity: int, turn: int):
    def run(key, table):
        order = np.lexsort((table["start"].to_numpy(), table["d"].to_numpy(), -table["length"].to_numpy()))
        table = table.take(pa.array(order))
        size = table["length"].to_pylist()
        bins = pack_group(size, capacity)
        if "sequence_id" in table.column_names:
            old = table["sequence_id"].to_pylist()
            if len(set(old)) <= len(bins):                   # packed no better than before
                by: dict[int, list[int]] = {}
                for i, s in enumerate(old):
                    by.setdefault(s, []).append(i)
                bins = list(by.values())
        seq, at, free = [0] * len(size), [0] * len(size), [0] * len(size)
        base = (turn << 60) | (key[0].as_py() << 20)
        for k, b in enumerate(bins):
            place = 0
            for i in b:
                seq[i], at[i] = base + k, place
                place += size[i]
            for i in b:
                free[i] = capacity - place
        kept = table.select(["d", "piece", "start", "length", "ids_crc32"])
        for name, values in (("sequence_id", seq), ("offset", at), ("free", free)):
            kept = kept.append_column(name, pa.array(values, pa.int64()))
        return kept

    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of ``(d, piece, start, length, ids_crc32)``."""
    def deal(df, *by):
        n = max(1, -(-df.count() // group))
        return df.withColumn("pack_group", F.pmod(F.xxhash64(*by), F.lit(n)))

    # dealt by a number of their own, written with them: rows that repeat an id,
    # or have none, spread over all groups like others
    pieces = stage(pieces.withColumn("own", F.monotonically_increasing_id()), "pieces")
    first = stage(deal(pieces, "own").drop("own").groupBy("pack_group")
                  .applyInArrow(_packer(capacity, 1), PACKED), "packed")
    again = deal(first.where(F.col("free") >= UNDERFULL), "sequence_id")
    second = again.groupBy("pack_group").applyInArrow(_packer(capacity, 2), PACKED)
    return first.where(F.col("free") < UNDERFULL).unionByName(second).drop("free")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sequences for all documents: ``(id, piece, start, length, ids_crc32,
    sequence_id, offset)``.  Null or empty texts give one piece that holds the
    end id alone; null ids stay null; repeated rows are packed once each.  An
    empty table gives an empty result."""
    ship(docs.sparkSession)
    out = pack_pieces(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col), capacity)
    return out.withColumn("d", id_back(F.col("d"))).withColumnRenamed("d", id_col)
