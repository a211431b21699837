"""Pairs and nearest neighbours of sets over few distinct elements (D5-D8).

Where the sets draw on a few hundred elements, nearly every two of them share a
bucket or a prefix token, so a join on groups meets almost all pairs, each at the
price of a joined row.  Here a set is a row of bits.  The rows are dealt into
blocks, every block meets every other one in a task of its own, and the overlaps
of a tile of two blocks are one matrix product.

A task holds two blocks (:data:`MOST_LEFT` and :data:`MOST_RIGHT` sets at most)
and one tile; pairs leave it tile by tile.  Overlaps are whole numbers, exact in
the product; what a bound in floating point lets through is tested on them again.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lshark.functions.minhash import MinHashModel
from lshark.session import cut_lineage, ship

ITEMS = 512                    # distinct elements up to which sets are rows of bits
FROM_PAIRS = 2_000_000         # pairs of sets from which blocks are worth their set-up
GROUP_COST = 30                # price of a pair in a group join, where a dense one costs 2 + elements / 32
TOP_DEARER = 10                # times that where the join counts the overlap of most pairs, as a top-k does
LEAST_BLOCK, MOST_LEFT, MOST_RIGHT = 2048, 32_768, 65_536
TILE, WIDE = 512, 2048         # rows and most columns of a tile
FIRST = 64                     # columns of the first tile of a top-k

_BLOCK = "blk int, u binary, n binary, hashes binary, bits binary"


def elements(*sides: DataFrame) -> list[int] | None:
    """The sorted elements of all sides, if they are :data:`ITEMS` at most and
    every key is a non-null bigint; else None."""
    long = T.LongType()
    if any(s.schema["u"].dataType != long or s.schema["i"].dataType != long for s in sides):
        return None
    found = sides[0].select("i")
    for s in sides[1:]:
        found = found.unionByName(s.select("i"))
    got = [r["i"] for r in found.distinct().limit(ITEMS + 1).collect()]
    if len(got) > ITEMS or None in got or any(s.where("u IS NULL").limit(1).count() for s in sides):
        return None
    return sorted(got)


def cheaper(pairs: float, group_pairs: float, items: int, dearer: float = 1) -> bool:
    """Whether ``pairs`` of blocks cost less than ``group_pairs`` of a group join
    (``dearer`` times the usual price each)."""
    return pairs >= FROM_PAIRS and pairs * (2 + items / 32) <= dearer * GROUP_COST * group_pairs


def bit_sets(inter: DataFrame, items: list[int], model: MinHashModel | None) -> DataFrame:
    """``(u, n, hashes, bits)`` per set of distinct ``(u, i)`` rows."""
    index = inter.sparkSession.createDataFrame([(i, k // 64, k % 64) for k, i in enumerate(items)], "i bigint, _w int, _p int")
    rows = inter.join(F.broadcast(index), "i")                  # ITEMS rows
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_p"))
    words, tables = -(-len(items) // 64), model.num_tables if model else 0
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.min(model.hash_col(F.col("i"), t)).alias(f"_h{t}") for t in range(tables)]
    aggs += [F.coalesce(F.bit_or(F.when(F.col("_w") == w, one)), F.lit(0).cast("bigint")).alias(f"_m{w}") for w in range(words)]
    hashes = F.array(*[f"_h{t}" for t in range(tables)]) if tables else F.array().cast("array<bigint>")
    sets = rows.groupBy("u").agg(*aggs)
    return cut_lineage(sets.select("u", "n", hashes.alias("hashes"), F.array(*[f"_m{w}" for w in range(words)]).alias("bits")),
                       "bit-sets")


def _packed(table: pa.Table) -> pa.Table:
    """The sets of one block, by rising ``u``, as one row of byte strings."""
    u = table["u"].to_numpy()
    order = np.argsort(u)

    def lists(name: str) -> bytes:
        flat = table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        return flat.reshape(len(u), -1)[order].tobytes()

    return pa.table({"blk": pa.array([table["blk"][0].as_py()], pa.int32()),
                     "u": pa.array([u[order].tobytes()], pa.binary()),
                     "n": pa.array([table["n"].to_numpy()[order].astype(np.int64).tobytes()], pa.binary()),
                     "hashes": pa.array([lists("hashes")], pa.binary()), "bits": pa.array([lists("bits")], pa.binary())})


def blocks(sets: DataFrame, count: int) -> DataFrame:
    """The sets in ``count`` blocks, a row each."""
    ship(sets.sparkSession)
    dealt = sets.withColumn("blk", F.pmod(F.xxhash64("u"), F.lit(count)).cast("int"))
    return cut_lineage(dealt.groupBy("blk").applyInArrow(_packed, _BLOCK), "blocks")


def _count(n: int, least: int, most: int, tasks: int) -> int:
    return max(1, -(-n // min(max(-(-n // tasks), least), most)))


def _grid(left: DataFrame, right: DataFrame, nl: int, nr: int, same: bool) -> DataFrame:
    """One row per two blocks that meet, columns ``l_*`` and ``r_*``; of one table's
    blocks each two meet once."""
    cols = ("u", "n", "hashes", "bits")
    l = left.select(F.col("blk").alias("p"), *[F.col(c).alias(f"l_{c}") for c in cols])
    l = l.withColumn("q", F.explode(F.sequence(F.col("p") if same else F.lit(0), F.lit(nr - 1))))
    r = right.select(F.col("blk").alias("q"), *[F.col(c).alias(f"r_{c}") for c in cols])
    r = r.withColumn("p", F.explode(F.sequence(F.lit(0), F.col("q") if same else F.lit(nl - 1))))
    tasks = nl * (nl + 1) // 2 if same else nl * nr
    return l.repartition(tasks, "p", "q").join(r.repartition(tasks, "p", "q"), ["p", "q"])


class _Side:
    """A block unpacked: ids, sizes, signatures and rows of 0 and 1."""

    def __init__(self, row: dict, side: str, items: int):
        self.u, self.n = (np.frombuffer(row[f"{side}_{c}"], np.int64) for c in ("u", "n"))
        self.hashes, words = (np.frombuffer(row[f"{side}_{c}"], np.int64).reshape(len(self.u), -1) for c in ("hashes", "bits"))
        flags = np.unpackbits(words.astype("<i8").view(np.uint8), axis=1, count=items, bitorder="little")
        self.rows = flags.astype(np.float32)
        self.size = self.n.astype(np.float32)

    def part(self, second: int, hashes: int, split: int, items: int) -> _Side:
        """The first or second of two tables' sets that :func:`common_counts` packed into one block."""
        one = object.__new__(_Side)
        one.u, one.n = self.u, self.hashes[:, 0] if second else self.n
        one.hashes = self.hashes[:, 1 + hashes:] if second else self.hashes[:, 1:1 + hashes]
        one.rows = np.ascontiguousarray(self.rows[:, split:split + items] if second else self.rows[:, :items])
        one.size = one.n.astype(np.float32)
        return one


def _blocks_met(batches: Iterator[pa.RecordBatch], items: int) -> Iterator[tuple[_Side, _Side, bool]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            yield _Side(row, "l", items), _Side(row, "r", items), row["p"] == row["q"]


def _shares(l: _Side, r: _Side, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the sets agree on an entry of their signatures."""
    found = np.zeros(len(x), bool)
    for t in range(l.hashes.shape[1]):
        found |= l.hashes[x, t] == r.hashes[y, t]
    return found


class Met(NamedTuple):
    """What a table of pairs of one table's sets comes from, so that a report can
    count the pairs tile by tile where they are found: without ``least`` they
    agree on an entry of their signatures, else they are those of :func:`pairs`
    with a distance below ``threshold``."""
    sets: DataFrame
    count: int
    items: int = 0
    least: float | None = None
    check: bool = True
    threshold: float | None = None


def noted(found: DataFrame, met: Met) -> DataFrame:
    found.__dict__["_lshark_met"] = met
    return found


def met_of(found: DataFrame) -> Met | None:
    return found.__dict__.get("_lshark_met")


def _near_tile(overlap: np.ndarray, l: _Side, r: _Side, i: int, j: int, least: float, check: bool,
               ordered: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(x, y, overlap)`` of the pairs of a tile that reach the similarity ``least`` (and a few below)."""
    share = least / (1.0 + least)
    need = share * l.size[i:i + TILE, None] + share * r.size[None, j:j + WIDE] - np.float32(0.01)
    x, y = np.divmod(np.flatnonzero(overlap >= np.maximum(need, np.float32(0.5), out=need)), overlap.shape[1])
    known = overlap[x, y].astype(np.int32)
    x, y = x + i, y + j
    keep = _shares(l, r, x, y) if check else np.ones(len(x), bool)
    if ordered:
        keep &= l.u[x] < r.u[y]
    return x[keep], y[keep], known[keep]


def pairs(left: DataFrame, n_left: int, right: DataFrame | None, n_right: int, items: int, least: float,
          check: bool) -> DataFrame:
    """``(a, b, inter, n_a, n_b)`` of the pairs of similarity ``least`` or more
    (and a few below) with a common element, from :func:`bit_sets` over ``items``
    elements: ``a < b`` of one table, or ``a`` of the left and ``b`` of the right.
    With ``check`` the two agree on an entry of their signatures."""
    same = right is None

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for l, r, diagonal in _blocks_met(batches, items):
            for i in range(0, len(l.u), TILE):
                for j in range(0, len(r.u), WIDE):
                    overlap = l.rows[i:i + TILE] @ r.rows[j:j + WIDE].T
                    x, y, known = _near_tile(overlap, l, r, i, j, least, check, same and diagonal)
                    a, b, n_a, n_b = l.u[x], r.u[y], l.n[x], r.n[y]
                    if same:
                        turn = a > b
                        a, b = np.where(turn, b, a), np.where(turn, a, b)
                        n_a, n_b = np.where(turn, n_b, n_a), np.where(turn, n_a, n_b)
                    if len(a):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(a), pa.array(b), pa.array(known), pa.array(n_a.astype(np.int32)), pa.array(n_b.astype(np.int32))],
                            ["a", "b", "inter", "n_a", "n_b"])

    nl = _count(n_left, LEAST_BLOCK, MOST_LEFT, 16)
    nr = nl if same else _count(n_right, LEAST_BLOCK, MOST_LEFT, 16)
    one = blocks(left, nl)
    grid = _grid(one, one if same else blocks(right, nr), nl, nr, same)
    found = grid.mapInArrow(met, "a bigint, b bigint, inter int, n_a int, n_b int")
    return found.select("a", "b", *[F.col(c).cast("bigint").alias(c) for c in ("inter", "n_a", "n_b")])


def _agreeing(l: _Side, r: _Side, diagonal: bool) -> Iterator[tuple[int, int, np.ndarray]]:
    """The tiles ``(i, j, flags)`` of two blocks: which sets agree on an entry of their signatures."""
    for i in range(0, len(l.u), TILE):
        for j in range(0, len(r.u), WIDE):
            x, y = l.hashes[i:i + TILE], r.hashes[j:j + WIDE]
            agree = np.zeros((len(x), len(y)), bool)
            for t in range(x.shape[1]):
                agree |= x[:, t][:, None] == y[:, t][None, :]
            if diagonal:
                agree &= l.u[i:i + TILE, None] < r.u[None, j:j + WIDE]
            yield i, j, agree


def _one_grid(sets: DataFrame, count: int) -> DataFrame:
    n = _count(count, LEAST_BLOCK, MOST_LEFT, 16)
    one = blocks(sets, n)
    return _grid(one, one, n, n, True)


def _signed(sets: DataFrame) -> DataFrame:
    return sets.select("u", "n", "hashes", F.array().cast("array<bigint>").alias("bits"))


def sharing_pairs(sets: DataFrame, count: int) -> DataFrame:
    """``(a, b)``, ``a < b``, of the ``count`` sets ``(u, n, hashes)`` that agree on an entry of their signatures."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for l, r, diagonal in _blocks_met(batches, 0):
            for i, j, agree in _agreeing(l, r, diagonal):
                y = np.nonzero(agree)[1]
                if len(y):
                    ends = np.concatenate([[0], np.cumsum(agree.sum(axis=1))]).astype(np.int32)
                    near = pa.ListArray.from_arrays(pa.array(ends), pa.array(r.u[y + j]))
                    yield pa.RecordBatch.from_arrays([pa.array(l.u[i:i + TILE]), near], ["u", "near"])

    # a list per set and tile: Spark takes over a row of Arrow at a much higher price than an element
    found = _one_grid(_signed(sets), count).mapInArrow(met, "u bigint, near array<bigint>")
    found = found.select("u", F.explode("near").alias("v"))
    return noted(found.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")), Met(sets, count))


def sharing_count(met: Met) -> DataFrame:
    """``n``: the number of :func:`sharing_pairs`, a row per two blocks; the pairs are met but not written out."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for l, r, diagonal in _blocks_met(batches, 0):
            n = sum(int(np.count_nonzero(agree)) for _, _, agree in _agreeing(l, r, diagonal))
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return _one_grid(_signed(met.sets), met.count).mapInArrow(counted, "n bigint")


def common_counts(exact: Met, approx: Met) -> DataFrame:
    """``(exact_pairs, found_pairs, true_pairs)``: the pairs of two tables of
    pairs and those in both, a row per two blocks.  Each table's pairs are found
    from its own sets as :func:`pairs` finds them and meet in the tile where both
    lie, so no pair is shuffled."""
    words, split = [-(-m.items // 64) for m in (exact, approx)], 64 * -(-exact.items // 64)

    def sides(m: Met, x: str) -> DataFrame:
        return m.sets.select("u", *[F.col(c).alias(f"{x}_{c}") for c in ("n", "hashes", "bits")])

    def zeros(k: int):
        return F.array_repeat(F.lit(0).cast("bigint"), k)

    # a set of one table only is empty in the other: it meets nothing there
    width = len(approx.sets.select("hashes").first()[0]) if approx.check else 0
    wide = len(exact.sets.select("hashes").first()[0]) if exact.check else 0
    both = sides(exact, "e").join(sides(approx, "x"), "u", "full_outer").select(
        "u", F.coalesce("e_n", F.lit(0).cast("bigint")).alias("n"),
        F.concat(F.array(F.coalesce("x_n", F.lit(0).cast("bigint"))), F.coalesce("e_hashes", zeros(wide)),
                 F.coalesce("x_hashes", zeros(width))).alias("hashes"),
        F.concat(F.coalesce("e_bits", zeros(words[0])), F.coalesce("x_bits", zeros(words[1]))).alias("bits"))
    both = cut_lineage(both, "both-sets")
    tests = [(m.items, m.least, m.check, m.threshold) for m in (exact, approx)]

    def near(overlap, l, r, i, j, diagonal, least, check, threshold):
        x, y, known = _near_tile(overlap, l, r, i, j, least, check, diagonal)
        if threshold is None:
            return x - i, y - j
        keep = 1.0 - known.astype(np.float64) / (l.n[x] + r.n[y] - known).astype(np.float64) < threshold
        return x[keep] - i, y[keep] - j

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for l, r, diagonal in _blocks_met(batches, split + 64 * words[1]):
            halves = [tuple(s.part(k, wide, split, tests[k][0]) for s in (l, r)) for k in (0, 1)]
            same = tests[0][0] == tests[1][0] and all(np.array_equal(halves[0][k].rows, halves[1][k].rows) for k in (0, 1))
            n = np.zeros(3, np.int64)
            for i in range(0, len(l.u), TILE):
                for j in range(0, len(r.u), WIDE):
                    found, overlap = [], None
                    for (a, b), (_, *test) in zip(halves, tests, strict=True):
                        if overlap is None or not same:
                            overlap = a.rows[i:i + TILE] @ b.rows[j:j + WIDE].T
                        found.append(near(overlap, a, b, i, j, diagonal, *test))
                    at = np.zeros(overlap.shape, bool)
                    at[found[0]] = True
                    n += (len(found[0][0]), len(found[1][0]), int(np.count_nonzero(at[found[1]])))
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()) for k in n.tolist()], names)

    names = ["exact_pairs", "found_pairs", "true_pairs"]
    return _one_grid(both, both.count()).mapInArrow(counted, ", ".join(f"{c} bigint" for c in names))


def _nearest_in(l: _Side, r: _Side, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(u, v, sim)``: the ``k`` best candidates in ``r`` of every set of ``l``.

    Candidates come by rising ``v``, so one that only equals the ``k``-th best so
    far loses the tie: a set must beat it, and many equal sets stay cheap.

    The product itself takes off the overlap that the ``k``-th best asks for,
    ``share * (n_u + n_v)``, by two more columns.  Shares are cut to whole steps so
    small that every sum of the product is exact in single precision; cutting only
    lets more through, and what beats the ``k``-th best is at least twice ``beyond``."""
    out = []
    most = max(l.n.max(), r.n.max(), 1)
    step, beyond = 2.0 ** (int(most - 1).bit_length() - 24), np.float32(1.0 / (4 * most))
    right = np.concatenate([r.rows, r.size[:, None], np.ones((len(r.u), 1), np.float32)], axis=1)
    for i in range(0, len(l.u), TILE):
        n, m = l.n[i:i + TILE], len(l.u[i:i + TILE])
        best, who = np.zeros((m, k)), np.full((m, k), -1, np.int64)
        left = np.concatenate([l.rows[i:i + TILE], np.zeros((m, 2), np.float32)], axis=1)
        j, width = 0, FIRST
        while j < len(r.u):
            y_to = min(j + width, len(r.u))
            share = np.floor(best[:, -1] / (1.0 + best[:, -1]) / step) * step
            left[:, -2], left[:, -1] = -share, -share * n
            spare = left @ right[j:y_to].T
            x, y = np.divmod(np.flatnonzero(spare > beyond), y_to - j)
            spare = spare[x, y]
            y += j
            common = (spare + share[x] * (n[x] + r.n[y])).astype(np.int64)
            sim = common.astype(np.float64) / (n[x] + r.n[y] - common).astype(np.float64)
            keep = (sim > best[x, -1]) & (l.u[x + i] != r.u[y]) & _shares(l, r, x + i, y)
            x, y, sim = x[keep], y[keep], sim[keep]
            if len(x):
                rows = np.unique(x)
                at = np.concatenate([np.repeat(rows, k), x])
                v = np.concatenate([who[rows].ravel(), y])
                s = np.concatenate([best[rows].ravel(), sim])
                order = np.lexsort((v, -s, at))
                at, v, s = at[order], v[order], s[order]
                starts = np.searchsorted(at, rows)
                take = (starts[:, None] + np.arange(k)[None, :])
                best[rows], who[rows] = s[take], v[take]
            j, width = y_to, min(2 * width, WIDE)
        x, place = np.nonzero(best > 0)
        out.append((l.u[x + i], r.u[who[x, place]], best[x, place]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def nearest_pairs(sets: DataFrame, count: int, items: int, k: int) -> DataFrame:
    """Directed ``(u, v, sim)`` that hold the ``k`` nearest candidates of every
    set of :func:`bit_sets` (and others: the ``k`` best of each block)."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for l, r, _ in _blocks_met(batches, items):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _nearest_in(l, r, k)], ["u", "v", "sim"])

    nl, nr = _count(count, LEAST_BLOCK, MOST_LEFT, 16), _count(count, LEAST_BLOCK, MOST_RIGHT, 4)
    grid = _grid(blocks(sets, nl), blocks(sets, nr), nl, nr, False)
    return grid.mapInArrow(met, "u bigint, v bigint, sim double")
