"""Suffix-array dedup of byte strings by bucket-pointer refinement (operator 10).

Every byte covered by a ``length``-byte string that also starts anywhere else
is removed.

1. A count-min sketch of anchors (see :mod:`hashing`) marks the stretches that
   can hold repeated strings; a repeated string always has a repeated anchor.
2. Stretches of equal content are grouped by Spark.  One that occurs twice is
   repeated as a whole.
3. Different stretches with one anchor form a bucket and are sorted:
   :func:`refine` builds the suffix order of their bytes up to ``length`` by
   bucket-pointer refinement.  A bucket of more than ``BUCKET`` stretches is
   first refined across the cluster: each stretch is cut in two where the
   anchor's place in the window passes the middle, and each half goes to the
   bucket of all bytes that its windows have in common.  Halves of equal
   content are grouped again.  This is repeated until all buckets fit a task;
   a half of a single window has nothing left to differ in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lshark.llm import hashing, sketch
from lshark.llm.common import batch, id_back, in_task, ints, keyed_texts, ship, stage, text_bytes

LENGTH = 200
ANCHOR = 40
BUCKET = 2048                # stretches of one bucket sorted in one task
CHUNK = 1 << 20              # bytes sorted at once (whole buckets, so a little more)


def refine(data: np.ndarray, length: int, q: int = 8) -> np.ndarray:
    """Bucket pointer of every position: positions have equal pointers exactly
    if the ``length`` bytes from there are equal (zero bytes follow the end).

    The first buckets are the ``q``-grams.  A pass sorts the positions of each
    bucket on the pointers ``depth`` bytes further, which are themselves
    refined to ``depth``, so every pass doubles the depth; the last step
    overlaps to end at ``length`` exactly.  Positions alone in their bucket
    are final and are not sorted again.
    """
    n = len(data)
    q = min(q, length)
    gram = np.zeros(n, np.uint64)
    padded = np.concatenate((data, np.zeros(q, np.uint8)))
    for k in range(q):
        gram = (gram << np.uint64(8)) | padded[k:k + n]
    order = np.argsort(gram)
    sorted_gram = gram[order]
    new = np.ones(n, bool)
    new[1:] = sorted_gram[1:] != sorted_gram[:-1]
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    pointer = np.empty(n + length + 1, np.int64)
    pointer[n:] = -1
    pointer[order] = start
    depth = q
    active = order[_shared(start)]
    while depth < length and len(active):
        step = min(depth, length - depth)
        base, key = pointer[active], pointer[active + step]
        by = np.argsort(base * (n + 2) + key)
        active, base, key = active[by], base[by], key[by]
        first = np.ones(len(active), bool)
        first[1:] = base[1:] != base[:-1]
        split = first.copy()
        split[1:] |= key[1:] != key[:-1]
        rank = np.arange(len(active))
        inside = rank - np.maximum.accumulate(np.where(first, rank, 0))
        start = base + np.maximum.accumulate(np.where(split, rank, 0)) - (rank - inside)
        pointer[active] = start
        active = active[_shared(start)]
        depth += step
    return pointer[:n]


def _shared(start: np.ndarray) -> np.ndarray:
    """Mask of sorted pointers that occur more than once."""
    same = start[1:] == start[:-1]
    out = np.zeros(len(start), bool)
    out[1:] = same
    out[:-1] |= same
    return out


def _ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _runs(b: pa.RecordBatch, length: int, q: int):
    buf, off = text_bytes(b.column("text"))
    table = hashing.byte_table()
    for i, j, s, e in hashing.segments(off, length):
        if e - s < length:
            continue
        text, first, n, h, c, o, _ = hashing.anchor_runs(table[buf[s:e]], np.clip(off[i:j + 1] - s, 0, e - s), length, q)
        if len(first):
            yield text + i, first + s - off[text + i], n, h, c, o


def repeated_runs(texts: DataFrame, length: int, q: int) -> DataFrame:
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = sketch.width_for(size * 2 / (length - q + 2))
    bits = spark.sparkContext.broadcast(sketch.merged(
        texts.select("text"), lambda b: (x[3] for x in _runs(b, length, q)), width))

    def emit(batches):
        for b in batches:
            d, f = ints(b.column("d")), ints(b.column("f"))
            for row, pos, n, h, c, o in _runs(b, length, q):
                k = np.flatnonzero(sketch.seen_twice(bits.value, h))
                if len(k):
                    yield batch(["d", "f", "pos", "n", "h", "c", "o"],
                                [d[row[k]], f[row[k]], pos[k], n[k], h[k].view(np.int64), c[k].view(np.int64), o[k]])

    return texts.mapInArrow(in_task(emit), "d long, f long, pos long, n long, h long, c long, o long")


PIECE = "d long, f long, pos long, h long, c long, n long, o long, bytes binary"
_PIECE = ["d", "f", "pos", "h", "c", "n", "o"]


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    *numbers, raw = zip(*rows, strict=True)
    return batch([*_PIECE, "bytes"], [*(pa.array(x, pa.int64()) for x in numbers), pa.array(raw, pa.binary())])


def _cut(length: int):
    """Bytes of the wanted stretches of each text."""
    def cut(batches):
        for b in batches:
            buf, off = text_bytes(b.column("text"))
            rows = []
            for i, (d, f, wanted) in enumerate(zip(b.column("d").to_pylist(), b.column("f").to_pylist(),
                                                   b.column("wanted").to_pylist(), strict=True)):
                raw = buf[off[i]:off[i + 1]]
                rows += [(d, f, x["pos"], x["h"], x["c"], x["n"], x["o"],
                          raw[x["pos"]:x["pos"] + x["n"] - 1 + length].tobytes()) for x in wanted]
                if len(rows) > 2000:
                    yield _pieces(rows)
                    rows = []
            if rows:
                yield _pieces(rows)
    return cut


def _halve(low: int, high: int, length: int, q: int):
    """Cut stretches whose windows have their anchor at places ``low`` to
    ``high`` into those of the upper and of the lower half of these places."""
    middle = (low + high + 1) // 2

    def run(batches):
        table = hashing.byte_table()
        for b in batches:
            rows = []
            numbers = zip(*(b.column(k).to_pylist() for k in _PIECE), strict=True)
            for (d, f, pos, h, _, n, o), raw in zip(numbers, b.column("bytes").to_pylist(), strict=True):
                p = hashing.Prefix(table[np.frombuffer(raw, np.uint8)])
                # the window that starts at i has its anchor at place o - i
                for lo, hi in ((middle, high), (low, middle - 1)):
                    s, e = max(0, o - hi), min(n - 1, o - lo)
                    if s > e:
                        continue
                    core = p.ranges(np.array([o - lo, s]), np.array([o - hi + length, e + length])).view(np.int64)
                    bucket = hashing.mix(np.array([h ^ (lo << 8) ^ int(core[0])], np.int64).view(np.uint64))
                    rows.append((d, f, pos + s, int(bucket.view(np.int64)[0]), int(core[1]), e - s + 1, o - s, lo,
                                 raw[s:e + length]))
            if rows:
                *cols, lo, raw = zip(*rows, strict=True)
                yield batch([*_PIECE, "low", "bytes"], [*(pa.array(x, pa.int64()) for x in (*cols, lo)),
                                                        pa.array(raw, pa.binary())])
    return run


def _sort_chunk(rows: list[tuple], length: int) -> list[tuple[int, int, int, int]]:
    """Spans of the windows that repeat among the rows ``(h, c, d, f, pos, n, bytes)``."""
    seen, unique = set(), []
    for r in rows:
        if (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            unique.append(r)
    data = np.frombuffer(b"".join(r[6] for r in unique), np.uint8)
    pointer = refine(data, length)
    ends = np.cumsum([len(r[6]) for r in unique])
    starts = ends - [len(r[6]) for r in unique]
    n = np.array([r[5] for r in unique])
    total = np.cumsum(n)
    windows = np.arange(total[-1]) + np.repeat(starts - (total - n), n)
    at = pointer[windows]
    order = np.argsort(at)
    twice = np.zeros(len(at), bool)
    twice[order] = _shared(at[order])
    out = []
    for r, lo, hi in zip(unique, (total - n).tolist(), total.tolist(), strict=True):
        if twice[lo:hi].any():
            out += [(r[2], r[3], r[4] + s, r[4] + e - 1 + length) for s, e in _ranges(twice[lo:hi])]
    return out


SPAN = "d long, f long, s long, e long"
HALF = "d long, f long, pos long, h long, c long, n long, o long, low long, bytes binary"


def _spans(found) -> pa.RecordBatch:
    return batch(["d", "f", "s", "e"], [pa.array(x, pa.int64()) for x in zip(*found, strict=True)])


def _sorter(length: int):
    """Suffix-sorts rows that arrive ordered by anchor, whole anchors at a time."""
    def run(batches):
        held, size, last = [], 0, None
        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in ("h", "c", "d", "f", "pos", "n", "bytes")), strict=True):
                if size >= CHUNK and row[0] != last:
                    if found := _sort_chunk(held, length):
                        yield _spans(found)
                    held, size = [], 0
                held.append(row)
                size += len(row[6])
                last = row[0]
        if held and (found := _sort_chunk(held, length)):
            yield _spans(found)
    return run


def _grouped(runs: DataFrame, copied, name: str) -> DataFrame:
    """One row per distinct content: whether it is copied, its first occurrence
    (``first``), windows and anchor place."""
    place = F.struct("d", "f", "pos")
    return stage(runs.groupBy("h", "c").agg(copied.alias("copied"), F.min(place).alias("first"),
                                            F.min("n").alias("n"), F.min("o").alias("o")), name)


def _whole(runs: DataFrame, groups: DataFrame, length: int) -> DataFrame:
    """Spans of the runs whose content occurs more than once."""
    return (runs.join(groups.where("copied").select("h", "c"), ["h", "c"])
            .select("d", "f", F.col("pos").alias("s"), (F.col("pos") + F.col("n") - 1 + length).alias("e")))


def _mixed(groups: DataFrame, name: str) -> DataFrame:
    """Buckets of several contents, with their number."""
    return stage(groups.groupBy("h").agg(F.count("*").alias("k")).where("k > 1"), name)


def _sorted(pieces: DataFrame, length: int) -> DataFrame:
    """Spans from the suffix sort of the pieces, whole buckets in a task."""
    return (pieces.repartition("h").sortWithinPartitions("h")
            .select("h", "c", "d", "f", "pos", "n", "bytes").mapInArrow(in_task(_sorter(length)), SPAN))


def removal_spans(texts: DataFrame, length: int = LENGTH, q: int = ANCHOR, bucket: int = BUCKET) -> DataFrame:
    """``(d, f, s, e)``: byte ranges to remove (they may overlap)."""
    runs = stage(repeated_runs(texts, length, q), "byte-runs")
    groups = _grouped(runs, F.count("*") > 1, "byte-groups")
    spans = _whole(runs, groups, length)
    sizes = _mixed(groups, "byte-buckets")
    wanted = (groups.join(sizes, "h").select("h", "c", "n", "o", "first.*")
              .groupBy("d", "f").agg(F.collect_list(F.struct("h", "c", "n", "pos", "o")).alias("wanted")))
    # rows that repeat a document count above, as copies; one of them is cut
    pieces = (texts.dropDuplicates(["d", "f"]).join(wanted, ["d", "f"]).select("d", "f", "text", "wanted")
              .mapInArrow(in_task(_cut(length)), PIECE))
    pieces = stage(pieces, "byte-pieces")
    ranges, depth = [(0, length - q)], 0
    while True:
        big = stage(sizes.where(F.col("k") > bucket).select("h"), "byte-big")
        if big.isEmpty():
            return spans.unionByName(_sorted(pieces.join(sizes.select("h"), "h", "left_semi"), length))
        fit = sizes.where(F.col("k") <= bucket).select("h")
        spans = spans.unionByName(_sorted(pieces.join(fit, "h", "left_semi"), length))
        large, halves = pieces.join(big, "h", "left_semi"), None
        for lo, hi in ranges:
            own = large if depth == 0 else large.where(F.col("low") == lo)
            if lo < hi:
                half = own.select(*_PIECE, "bytes").mapInArrow(in_task(_halve(lo, hi, length, q)), HALF)
                halves = half if halves is None else halves.unionByName(half)
        halves = stage(halves, "byte-halves")
        place = F.struct("d", "f", "pos")
        groups = _grouped(halves, F.min(place) < F.max(place), "byte-half-groups")
        spans = spans.unionByName(_whole(halves, groups, length))
        sizes = _mixed(groups, "byte-half-buckets")
        heads = groups.join(sizes, "h").select("h", "c", "first.*")
        pieces = stage(halves.join(heads, ["h", "c", "d", "f", "pos"]).select(*_PIECE, "low", "bytes"), "byte-half-pieces")
        ranges = [x for lo, hi in ranges if lo < hi
                  for m in [(lo + hi + 1) // 2] for x in ((m, hi), (lo, m - 1))]
        depth += 1


def _merge(spans, n: int) -> list[tuple[int, int]]:
    """Maximal removed runs."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], min(e, n)))
        else:
            out.append((s, min(e, n)))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, q: int = ANCHOR, bucket: int = BUCKET) -> DataFrame:
    """Remaining bytes of every text: ``(id, n_bytes, n_removed, spans, kept)``.

    ``spans`` lists the maximal removed byte ranges, ``kept`` (binary) is what
    remains, concatenated.  Null texts are empty; texts shorter than
    ``length`` lose nothing.  Repeated rows are copies of each other and lose
    whatever they share, null ids included.  An empty table gives an empty
    result.
    """
    ship(docs.sparkSession)
    texts = keyed_texts(docs, id_col, text_col)
    spans = (removal_spans(texts, length, q, bucket).groupBy("d", "f")
             .agg(F.collect_set(F.struct("s", "e")).alias("found")))         # once, however many rows repeat a text

    def apply(batches):
        for b in batches:
            buf, off = text_bytes(b.column("text"))
            size, gone, cuts, kept = [], [], [], []
            for i, found in enumerate(b.column("found").to_pylist()):
                raw = buf[off[i]:off[i + 1]].tobytes()
                runs = _merge([(x["s"], x["e"]) for x in found], len(raw)) if found else []
                if runs:
                    edges = [0, *(x for r in runs for x in r), len(raw)]
                    kept.append(b"".join(raw[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True)))
                else:
                    kept.append(raw)
                size.append(len(raw))
                gone.append(len(raw) - len(kept[-1]))
                cuts.append([{"s": s, "e": e} for s, e in runs])
            yield batch(["d", "n_bytes", "n_removed", "spans", "kept"],
                        [b.column("d"), pa.array(size, pa.int64()), pa.array(gone, pa.int64()),
                         pa.array(cuts, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                         pa.array(kept, pa.binary())])

    joined = texts.join(spans, ["d", "f"], "left").select("d", "f", "text", "found")
    out = joined.mapInArrow(in_task(apply), "d long, n_bytes long, n_removed long, spans array<struct<s:long,e:long>>, kept binary")
    return out.withColumn("d", id_back(F.col("d"))).withColumnRenamed("d", id_col)


def digest(kept: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return kept.select(id_col, "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
                       F.sha2(F.col("kept"), 256).alias("kept_sha256"))
