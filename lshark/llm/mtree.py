"""Exact top-k inner products by M-tree best-first search (operator 5).

Inner products become distances when every vector gets one more coordinate
that lifts it to a common length, so the nearest rows of a query are those of
highest score.  Spark deals the rows into parts; each part builds an M-tree of
paged nodes that store, per entry, its routing vector, covering radius and
distance to the parent's routing vector.  Queries run through a part's tree
best-first.  An entry is skipped without computing a distance where the stored
distances and the triangle inequality already rule it out.  Bounds carry a
margin for rounding and scores are exact integers, so the result is exact.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lshark.llm.common import batch, id_back, id_key, in_task, ints, ship, stage

TOP = 5
PAGE = 256
PART_ROWS = (2048, 1 << 15)  # least and most rows of a part
QUERY_ROWS = 1 << 16         # queries streamed through one build of a part's tree
SCALE = 256
LONG = 1 << 63


class Node:
    """A page: routing vectors, and for inner pages radii and children, for
    leaves row numbers; ``to_parent`` are distances to the parent's vector."""

    __slots__ = ("points", "radius", "to_parent", "children", "rows")

    def __init__(self, points, to_parent, radius=None, children=None, rows=None):
        self.points, self.to_parent, self.radius, self.children, self.rows = points, to_parent, radius, children, rows


def _distance(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    d = x - p
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def build(x: np.ndarray, rows: np.ndarray, parent: np.ndarray | None = None, page: int = PAGE) -> Node:
    """Bulk-load: pivots far from each other, every row to its nearest pivot."""
    to_parent = _distance(x[rows], parent) if parent is not None else np.zeros(len(rows))
    if len(rows) <= page:
        return Node(x[rows], to_parent, rows=rows)
    n = min(page, -(-len(rows) // page))
    pivots = [int(rows[0])]
    near = _distance(x[rows], x[pivots[0]])
    owner = np.zeros(len(rows), np.int64)
    while len(pivots) < n and near.max() > 0:
        pivots.append(int(rows[near.argmax()]))
        d = _distance(x[rows], x[pivots[-1]])
        owner[d < near] = len(pivots) - 1
        near = np.minimum(near, d)
    groups = [rows[owner == k] for k in range(len(pivots))]
    if len(pivots) == 1 or max(map(len, groups)) > 0.9 * len(rows):     # equal or nearly equal rows: cut evenly
        groups = np.array_split(rows, n)
        pivots = [int(g[0]) for g in groups]
    points = x[pivots]
    radius = np.array([_distance(x[g], x[p]).max() for g, p in zip(groups, pivots, strict=True)])
    children = [build(x, g, x[p], page) for g, p in zip(groups, pivots, strict=True)]
    return Node(points, _distance(points, parent) if parent is not None else np.zeros(len(pivots)), radius, children)


class Tree:
    """M-tree over integer vectors, searched by inner product."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE, keys: np.ndarray | None = None):
        """``vectors`` hold whole numbers, as longs or doubles; ``keys`` tell rows
        apart that share an id."""
        self.ids, self.keys = ids, ids if keys is None else keys
        x = vectors.astype(float)
        norm = (x * x).sum(axis=1)
        self.top = float(norm.max()) if len(norm) else 0.0
        self.largest = float(np.abs(x).max(initial=0))
        self.x = np.column_stack((x, np.sqrt(np.maximum(self.top - norm, 0))))
        self.root = build(self.x, np.arange(len(ids)), page=page)

    def scores(self, points: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact inner products: as doubles where no sum rounds, as longs where
        none wraps, else as whole numbers of any size."""
        most = self.largest * float(np.abs(q).max(initial=0)) * len(q)
        if most < 1 << 53:
            return points @ q
        if most < 1 << 62:
            return points.astype(np.int64) @ q.astype(np.int64)
        return np.array([sum(int(a) * int(b) for a, b in zip(p, q, strict=True)) for p in points.tolist()], object)

    def search(self, query_key: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The ``k`` best ``(score, id)`` other than the query's own row."""
        p = np.append(q.astype(float), 0.0)
        own = float((p * p).sum())
        real = p[:-1]
        margin = 1e-7 * (1 + np.sqrt(own + self.top)) ** 2    # on squared distances
        best: list[tuple[int, int]] = []                      # heap of (score, -id)
        limit = np.inf                                        # distance of the k-th best so far
        heap, count = [(0.0, 0, self.root, None)], 1
        while heap:
            low, _, node, to_parent = heappop(heap)
            if low > limit:
                break
            points, rows, keep = node.points, node.rows, None
            if to_parent is not None and limit < np.inf:      # |d(q, parent) - d(parent, entry)| - radius
                far = np.abs(to_parent - node.to_parent)
                ok = (far if node.radius is None else far - node.radius) <= limit
                if not ok.all():
                    keep = np.flatnonzero(ok)
                    if not len(keep):
                        continue
                    points = points[keep]
            if node.radius is None:
                rows = rows if keep is None else rows[keep]
                score = self.scores(points[:, :-1], real)
                if len(best) == k:
                    worth = np.flatnonzero(score >= best[0][0])
                elif len(score) > 4 * k and score.dtype != object:                      # with all ties of the k-th
                    worth = np.flatnonzero(score >= np.partition(score, -k - 1)[-k - 1])
                else:
                    worth = np.arange(len(score))
                worth, score = rows[worth], score[worth].tolist()
                for s, i, key in zip(score, self.ids[worth].tolist(), self.keys[worth].tolist(), strict=True):
                    s = int(s)
                    if key == query_key:
                        continue
                    if len(best) < k:
                        heappush(best, (s, -i))
                    elif (s, -i) > best[0]:
                        heappop(best)
                        heappush(best, (s, -i))
                if len(best) == k:
                    limit = np.sqrt(max(own + self.top - 2.0 * float(best[0][0]), 0.0) + margin)
            else:
                d = _distance(points, p)
                keep = np.arange(len(points)) if keep is None else keep
                floor = np.maximum(d - node.radius[keep], 0) - np.sqrt(margin) * 1e-3
                for n in np.flatnonzero(floor <= limit).tolist():
                    heappush(heap, (float(floor[n]), count, node.children[keep[n]], float(d[n])))
                    count += 1
        return sorted(((s, -i) for s, i in best), key=lambda t: (-t[0], t[1]))


def quantised(vec: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component, as a double (which holds such a
    whole number exactly); null for vectors that are null or hold null or
    non-finite components."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vec, lambda x: x.cast("double") * scale)
    # a double of 2**53 or more is whole, and may be beyond what floor can return
    return F.when(fine, F.transform(whole, lambda x: F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)))


def _searcher(k: int):
    """Rows sorted by part: first the part's rows, then queries."""
    def run(batches):
        key, tree, held = None, None, []
        for b in batches:
            part, role, ids, rows = (ints(b.column(c)) for c in ("part", "role", "id", "r"))
            dim, block = ints(b.column("dim")), ints(b.column("qblock"))
            flat = b.column("v").flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(dim)
            keys = np.column_stack((dim, part, block, role))
            edge = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]))
            for s, e in zip(edge[:-1], edge[1:], strict=True):
                here = tuple(keys[s, :3])
                v = flat[ends[s] - dim[s]:ends[e - 1]].reshape(-1, int(dim[s]))
                if here != key:
                    key, tree, held = here, None, []
                if role[s] == 0:
                    held.append((ids[s:e], v, rows[s:e]))
                    continue
                if tree is None:
                    if not held:
                        continue
                    tree = Tree(*(np.concatenate([x[c] for x in held]) for c in (0, 1)),
                                keys=np.concatenate([x[2] for x in held]))
                out = [(r, q, i, sc) for r, q, x in zip(rows[s:e].tolist(), ids[s:e].tolist(), v, strict=True)
                       for sc, i in tree.search(r, x, k)]
                if any(not -LONG <= x[3] < LONG for x in out):
                    raise OverflowError("a score among the best does not fit a long")
                if out:
                    yield batch(["r", "query_id", "vec_id", "score"], [pa.array(c, pa.int64()) for c in zip(*out, strict=True)])

    return run


def top_k(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = TOP,
          part_rows: tuple[int, int] = PART_ROWS) -> DataFrame:
    """Each query's ``k`` best rows by inner product: ``(query_id, rank,
    vec_id, score)``, ties to the smaller id, all rows if there are fewer.

    ``is_query`` picks the queries among the rows.  Vectors that are null,
    empty, or hold null or non-finite components take no part; a query meets
    only vectors of its own number of dimensions, and every row but its own:
    rows that repeat an id are rows of their own, as queries and as candidates,
    and a null id comes before all others.  Scores are exact at any size; one
    among the best that does not fit a long is an error.  An empty table gives
    an empty result.  Queries are dealt to all parts in blocks; neither side is
    collected or broadcast.
    """
    ship(rows.sparkSession)
    good = (rows.select(id_key(F.col(id_col)).alias("id"), quantised(F.col(vec_col)).alias("v"),
                        F.coalesce(is_query, F.lit(False)).alias("asks"))
            .where("v is not null and size(v) > 0")
            .withColumn("dim", F.size("v").cast("bigint")).withColumn("r", F.monotonically_increasing_id()))
    good = stage(good, "quantised")                            # row numbers hold from here on
    n, asked = good.agg(F.count("*"), F.count_if("asks")).first()
    parts = max(1, -(-n // min(max(n // 64, part_rows[0]), part_rows[1])))
    blocks = max(1, -(-asked // QUERY_ROWS))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    kept = good.select("dim", F.pmod(F.xxhash64("r"), F.lit(parts)).cast("int").alias("part"),
                       every(blocks).alias("qblock"), F.lit(0).alias("role"), "r", "id", "v")
    asks = good.where("asks").select("dim", every(parts).alias("part"),
                                     F.pmod(F.xxhash64("r", F.lit(1)), F.lit(blocks)).cast("int").alias("qblock"),
                                     F.lit(1).alias("role"), "r", "id", "v")
    key = ["dim", "part", "qblock"]
    found = (kept.unionByName(asks).repartition(*key).sortWithinPartitions(*key, "role", "id")
             .mapInArrow(in_task(_searcher(k)), "r long, query_id long, vec_id long, score long"))
    order = Window.partitionBy("r").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(id_back(F.col("query_id")).alias("query_id"), "rank", id_back(F.col("vec_id")).alias("vec_id"), "score"))
