"""Embedding near-dedup by a subspace pigeonhole join (operator 9).

Unit vectors of cosine ``c`` are at squared distance ``2 - 2c``.  Vectors are
rotated to their principal axes and cut into low-dimensional blocks; every
block gets a share of that squared distance in proportion to its variance.
Two near vectors are then within the share in at least one block, so a range
join per block finds all of them: vectors in the order of the block's first
axis meet those within the share's root of them.  Each candidate is verified
by its full cosine, and a pair is counted in the first block that admits it
only.

Equal vectors are joined beforehand.  A label's vectors are dealt into chunks
of bounded size and each two chunks meet once, in a task that joins them in
all blocks: a vector is sent once per chunk of its label, whatever the number
of blocks and cells.  A task returns link counts and a spanning forest, never
pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lshark.llm.common import batch, id_back, id_key, in_task, ints, ship, stage
from lshark.llm.components import components

THRESHOLD = 0.93
BLOCK = 8                    # coordinates of a block
CHUNK = 65_536               # vectors of a chunk, at most
LEAST_CHUNK = 1024           # vectors of a chunk where more chunks only serve more tasks
COORDINATES = 1 << 22        # coordinates of a chunk, at most, from LEAST_CHUNK vectors on
TASKS = 32                   # meetings of chunks to aim at, so that few labels keep a cluster busy
MOST_TASKS = 2000
TILE, WIDE = 512, 4096       # vectors compared at a time
#: Vectors the rotation is fitted on, at most, chosen by a hash; it only affects speed.
ROTATION_SAMPLE = 5_000
SLACK = 1 + 1e-6             # rounding of distances; verification is exact


def usable(vec: str) -> Column:
    """Whether a vector has finite components only and is not zero."""
    v = F.col(vec)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def rotations(vectors: DataFrame, sample: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per number of dimensions: rotation matrix and variance of each rotated axis."""
    rows = vectors.select("rep", "vec").orderBy(F.xxhash64("rep"), "rep").limit(sample).toArrow()
    by: dict[int, list] = {}
    for v in rows.sort_by("rep")["vec"].to_pylist():
        x = np.array(v, float)
        by.setdefault(len(v), []).append(x / np.abs(x).max())
    out = {}
    for dim, xs in by.items():
        x = np.array(xs)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        value, axes = np.linalg.eigh(np.cov(x.T, bias=True).reshape(dim, dim))
        out[dim] = axes[:, ::-1].copy(), np.maximum(value[::-1], 1e-9)
    return out


def layout(dim: int, variance: np.ndarray, threshold: float, block: int) -> list[tuple[np.ndarray, float]]:
    """Axes of each block, strongest first, and its squared-distance budget.
    Axes are dealt in turn, so that every block starts with a strong one."""
    m = max(1, dim // block)
    total = variance.sum()
    return [(np.arange(j, dim, m), (2 - 2 * threshold) * SLACK * variance[j::m].sum() / total) for j in range(m)]


def _turned(flat: np.ndarray, dim: int, turn) -> np.ndarray:
    """Unit vectors in rotated coordinates."""
    x = flat.reshape(-1, dim).astype(float)
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x @ turn[dim][0] if dim in turn else x


def _within(h: np.ndarray, left: np.ndarray, right: np.ndarray | None, budget: float):
    """Pairs ``(i, j)`` that may be within ``budget`` in the coordinates ``h`` of
    a block, tile by tile: of ``left`` and ``right``, or each two of ``left``."""
    reach = np.sqrt(budget) * (1 + 1e-9)
    left = left[np.argsort(h[left, 0], kind="stable")]
    right, same = (left, True) if right is None else (right[np.argsort(h[right, 0], kind="stable")], False)
    # the squared distance as one product; what single precision rounds is told apart afterwards
    square, one = (h * h).sum(axis=1, keepdims=True), np.ones((len(h), 1))
    l = np.concatenate((-2 * h, square, one), axis=1)[left].astype(np.float32)
    r = np.concatenate((h, one, square), axis=1)[right].astype(np.float32)
    first, limit = h[right, 0], np.float32(budget + 1e-5)
    for k in range(0, len(left), TILE):
        t = min(k + TILE, len(left))
        end = np.searchsorted(first, h[left[t - 1], 0] + reach, "right")
        start = k if same else np.searchsorted(first, h[left[k], 0] - reach, "left")
        for s in range(start, end, WIDE):
            e = min(s + WIDE, end)
            i, j = np.divmod(np.flatnonzero(l[k:t] @ r[s:e].T <= limit), e - s)
            if same:
                ahead = i + k < j + s
                i, j = i[ahead], j[ahead]
            if len(i):
                yield left[i + k], right[j + s]


def _near(x: np.ndarray, n_left: int, blocks: list, threshold: float):
    """Verified pairs of rows of ``x``, once each, in the first block that admits
    them: the first ``n_left`` rows with the others, or with one another if they are all."""
    left, right = np.arange(n_left), np.arange(n_left, len(x)) if n_left < len(x) else None
    for number, (cols, budget) in enumerate(blocks):
        for i, j in _within(x[:, cols], left, right, budget):
            for k in range(0, len(i), 1 << 15):
                home, who = i[k:k + (1 << 15)], j[k:k + (1 << 15)]
                a, b = x[home], x[who]
                good = np.einsum("ij,ij->i", a, b) >= threshold
                diff = (a - b) ** 2
                for c, limit in blocks[:number]:                # admitted by an earlier block already
                    good &= diff[:, c].sum(axis=1) > limit
                good &= diff[:, cols].sum(axis=1) <= budget
                if good.any():
                    yield np.column_stack((home[good], who[good]))


def _forest(pairs):
    """Enough of the pairs to connect what they connect: per later vector its first partner, per
    partner pair of one vector a link between the partners."""
    order = np.argsort(pairs[:, 1], kind="stable")
    home, who = pairs[order, 0], pairs[order, 1]
    first = home[np.searchsorted(who, who)]
    return np.unique(np.concatenate((np.column_stack((first, home)), np.column_stack((first, who)))), axis=0)


def _join(root: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The roots of all rows after joining the ends of ``pairs``; every row points at its root."""
    ends = root[pairs]
    ends = ends[ends[:, 0] != ends[:, 1]]
    if not len(ends):
        return root
    for i, j in _forest(ends).tolist():
        while root[i] != i:
            i = root[i]
        while root[j] != j:
            j = root[j]
        root[max(i, j)] = min(i, j)
    while not np.array_equal(up := root[root], root):
        root = up
    return root


def _met(dim: int, sides: list, turn, threshold: float, width: int):
    """``(rep, links, root)`` of the linked vectors of two chunks, or of one."""
    rep, copies, flat = (np.concatenate([p[c] for side in sides for p in side]) for c in range(3))
    x, n_left = _turned(flat, dim, turn), sum(len(p[0]) for p in sides[0])
    blocks = layout(dim, turn[dim][1] if dim in turn else np.ones(dim), threshold, width)
    links, root = np.zeros(len(rep), np.int64), np.arange(len(rep))
    for pairs in _near(x, n_left, blocks, threshold):
        np.add.at(links, pairs[:, 0], copies[pairs[:, 1]])
        np.add.at(links, pairs[:, 1], copies[pairs[:, 0]])
        root = _join(root, pairs)
    k = np.flatnonzero(links)
    return rep[k], links[k], rep[root[k]]


LINKS = "rep long, links long, root long"


def _joiner(turn, threshold, width):
    """Joins rows sorted by the two chunks that meet, those of the first chunk first."""
    def rows(key, sides):
        if sides[0] and (sides[1] or key[2] == key[3] and sum(len(p[0]) for p in sides[0]) > 1):
            found = _met(key[1], sides, turn, threshold, width)
            if len(found[0]):
                yield batch(["rep", "links", "root"], list(found))

    def run(batches):
        key, sides = None, [[], []]
        for b in batches:
            keys = np.column_stack([ints(b.column(c)) for c in ("label", "dim", "p", "q", "side")])
            rep, copies = ints(b.column("rep")), ints(b.column("copies"))
            vecs = b.column("vec")
            flat = vecs.flatten().to_numpy(zero_copy_only=False)
            off = np.concatenate(([0], np.cumsum(keys[:, 1])))
            edge = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]))
            for s, e in zip(edge[:-1], edge[1:], strict=True):
                if s == e:
                    continue
                here = tuple(keys[s, :4].tolist())
                if here != key:
                    if key is not None:
                        yield from rows(key, sides)
                    key, sides = here, [[], []]
                sides[keys[s, 4]].append((rep[s:e].copy(), copies[s:e].copy(), flat[off[s]:off[e]].copy()))
        if key is not None:
            yield from rows(key, sides)

    return run


def links(reps: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """``(rep, links, root)``: parts of the link counts of distinct vectors
    ``(label, vec, rep, copies)``, and edges that connect what the links do."""
    spark = reps.sparkSession
    turn = spark.sparkContext.broadcast(rotations(reps, ROTATION_SAMPLE))    # a matrix per dimension
    reps = reps.select("label", F.size("vec").cast("bigint").alias("dim"), "rep", "copies", "vec")
    sizes = reps.groupBy("label", "dim").agg(F.count("*").alias("n"))
    total = max(reps.count(), 1)
    held = F.least(F.lit(chunk), F.greatest(F.lit(LEAST_CHUNK), F.floor(F.lit(COORDINATES) / F.col("dim"))))
    spread = F.least(F.ceil(F.sqrt(F.lit(2.0 * TASKS / total) * F.col("n"))), F.ceil(F.col("n") / F.least(held, F.lit(LEAST_CHUNK))))
    chunks = F.greatest(F.ceil(F.col("n") / held), spread)
    # at most 2 * TASKS + total / chunk labels have more than one chunk
    sizes = stage(sizes.withColumn("chunks", chunks).where("chunks > 1").select("label", "dim", "chunks"), "chunk-counts")
    meetings = sizes.agg(F.sum(F.col("chunks") * (F.col("chunks") + 1) / 2)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(2 * int(meetings), MOST_TASKS))
    # a vector of chunk ``own`` goes to its meeting with each chunk, its own included
    dealt = (reps.join(F.broadcast(sizes), ["label", "dim"], "left")
             .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
             .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("chunks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))))
    met = dealt.select("label", "dim", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                       (F.col("other") < F.col("own")).cast("bigint").alias("side"), "rep", "copies", "vec")
    key = ["label", "dim", "p", "q"]
    met = met.repartition(parts, *key).sortWithinPartitions(*key, "side")
    return met.mapInArrow(in_task(lambda it: _joiner(turn.value, threshold, block)(it)), LINKS)


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """``(id, n_links, component_id, kept)`` per row.

    Only vectors of one label and one number of dimensions are compared; labels
    may be of any type (those that are no whole numbers are told apart by 64
    bits of hash).
    Vectors that are null, zero or hold null or non-finite components, and
    vectors without a label, link with nothing.  Rows repeating id, label and
    vector count as one vector; a null id comes before all others.  An empty
    table gives an empty result.
    """
    ship(rows.sparkSession)
    label = F.col(label_col)
    if not isinstance(rows.schema[label_col].dataType, T.IntegralType):
        label = F.when(label.isNotNull(), F.xxhash64(label))
    rows = rows.select(id_key(F.col(id_col)).alias("id"), F.col(vec_col).alias("vec"), label.cast("bigint").alias("label"))
    fit = F.col("label").isNotNull() & usable("vec")
    # single precision stays as it is: half the bytes, and the same numbers in a task
    single = rows.schema["vec"].dataType.elementType == T.FloatType()
    vector = F.col("vec") if single else F.transform("vec", lambda x: x.cast("double")).alias("vec")
    good = rows.where(fit).select("id", "label", vector)
    # 128 bits stand for label and vector wherever a vector's coordinates are not needed
    mark = [F.xxhash64("label", "vec").alias("h"), F.xxhash64(F.lit(1), "label", "vec").alias("g")]
    reps = stage(good.distinct().groupBy("label", "vec").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
                 .select("label", "vec", "rep", "copies", *mark, F.xxhash64("rep", "label", "vec").alias("node")), "vectors")
    reps = reps.where("rep is not null")
    found = stage(links(reps.select("label", "vec", F.col("node").alias("rep"), "copies"), threshold, block, chunk), "links")
    numbered = reps.select("h", "g", "rep", "copies", "node")
    counts = found.groupBy(F.col("rep").alias("node")).agg(F.sum("links").alias("links"))
    place = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = stage(numbered.join(counts, "node", "left").join(place, "node", "left"), "known")
    lowest = stage(known.where("component is not null").groupBy("component").agg(F.min("rep").alias("low")), "lowest")
    known = stage(known.join(lowest, "component", "left")
                  .select("h", "g", "copies", F.coalesce("links", F.lit(0)).alias("links"),
                          F.coalesce("low", "rep").alias("low")), "known-lowest")
    linked = (good.select("id", *mark).join(known, ["h", "g"])
              .select("id", (F.col("copies") - 1 + F.col("links")).alias("n_links"), F.col("low").alias("component")))
    alone = rows.where(~fit).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component"))
    return linked.unionByName(alone).select(
        id_back(F.col("id")).alias(id_col), "n_links", id_back(F.col("component")).alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"))
