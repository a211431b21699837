"""Embedding whitening by polarisation covariance (operator 13).

Entries become integers ``x = floor(1024 * c) + 100000``.  With ``q_t`` the sum
of squares of the centred column ``t``, a cross-covariance needs no products of
two columns: ``2 * cov(i, j) = var(i + j) - var(i) - var(j)``.

1. One pass sums every dimension (``S``, exact).
2. A second pass aggregates, for every dimension and every sum of two
   dimensions, the squares of the centred values, exactly: the centre is the
   integer nearest to the mean, and the half unit at most that is left goes
   out afterwards in whole numbers, so ``n * n * cov`` is an exact integer.
3. The driver assembles the ``dim x dim`` matrix, takes its eigenvectors and
   sends the leading ones back; a third pass projects every vector.

Tasks send sums only: a row of ``dim * (dim + 1) / 2`` numbers each, which a
grouped sum with a map-side part merges.  Whole numbers travel as limbs of 40
bits, so no sum rounds or wraps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lshark.llm.common import batch, in_task, ship, stage

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
BLOCK = 512                    # vectors whose squares are summed at once
LIMB = 40                      # bits of a limb of a whole number in transit
LIMBS = 5
ROOM = 1 << 62                 # entries from here on have no place in a long
SMALL = 1 << 26                # centred entries below this are squared in 64 bits
NOTHING = 1e-12                # share of the trace below which a direction has no variance


def entries(vec: Column) -> Column:
    """``vec`` as an array of doubles where it takes part, else null."""
    v = vec.cast("array<double>")
    fit = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float(ROOM // SCALE))))
    return F.when(F.coalesce(fit, F.lit(False)), v)


def whole(b: pa.RecordBatch) -> np.ndarray:
    """``x`` of every vector of a batch, as a matrix of longs."""
    col = b.column("v")
    flat = col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)
    return np.floor(SCALE * flat).astype(np.int64) + SHIFT


def limbs(x: int) -> list[int]:
    """A whole number as ``LIMBS`` limbs, the last one signed."""
    return [(x >> (LIMB * k)) & ((1 << LIMB) - 1) for k in range(LIMBS - 1)] + [x >> (LIMB * (LIMBS - 1))]


def unlimb(parts) -> int:
    return sum(int(p) << (LIMB * k) for k, p in enumerate(parts))


def _sums(vectors: DataFrame, per_batch, width: int) -> tuple[int, list[int]]:
    """``(rows, sums)``: ``per_batch`` turns a matrix into ``width`` whole
    numbers; they are added up over all rows."""
    def run(batches):
        total, rows = [0] * width, 0
        for b in batches:
            if b.num_rows:
                rows += b.num_rows
                total = [p + q for p, q in zip(total, per_batch(whole(b)), strict=True)]
        if rows:
            split = [limbs(t) for t in [rows, *total]]
            yield batch([f"l{k}" for k in range(LIMBS)],
                        [pa.array([[s[k] for s in split]], pa.list_(pa.int64())) for k in range(LIMBS)])

    names = [f"l{k}" for k in range(LIMBS)]
    parts = vectors.select("v").mapInArrow(in_task(run), ", ".join(f"{c} array<long>" for c in names))
    each = parts.select(F.posexplode(F.arrays_zip(*names)).alias("at", "z")).select("at", "z.*")
    merged = each.groupBy("at").agg(*[F.sum(c).alias(c) for c in names]).collect()        # width + 1 rows
    found = {r["at"]: unlimb([r[c] for c in names]) for r in merged}
    return found.get(0, 0), [found.get(k + 1, 0) for k in range(width)]


def column_sums(x: np.ndarray) -> list[int]:
    """Exact sum of every column."""
    x = x if int(np.abs(x).max(initial=0)) * len(x) < ROOM else x.astype(object)
    return [int(s) for s in x.sum(0)]


def squares(z: np.ndarray) -> list[int]:
    """Exact sums of the squares of every column and of every sum of two
    columns ``(i, j)``, ``i < j``, in that order."""
    dim = z.shape[1]
    total = [0] * (dim * (dim + 1) // 2)
    for at in range(0, len(z), BLOCK):
        part = z[at:at + BLOCK]
        part = part if np.abs(part).max(initial=0) < SMALL else part.astype(object)
        found = [int(s) for s in (part * part).sum(0)]
        for i in range(dim - 1):
            t = part[:, i + 1:] + part[:, i:i + 1]
            found += [int(s) for s in (t * t).sum(0)]
        total = [p + q for p, q in zip(total, found, strict=True)]
    return total


def square_norms(z: np.ndarray, n: int, rest: list[int]) -> list[int]:
    """``sum over dimensions of (n * z - rest) ** 2`` per row, exact."""
    most = n * int(np.abs(z).max(initial=0)) + max(map(abs, rest), default=0)
    if most < 1 << 57:
        y = n * z - np.array(rest, np.int64)
        h, l = y >> 30, y & ((1 << 30) - 1)
        if most < 1 << 28:
            return (y * y).sum(1).tolist()
        high, mid, low = (h.astype(object) ** 2).sum(1), (h.astype(object) * l).sum(1), (l.astype(object) ** 2).sum(1)
        return [(p << 60) + (q << 31) + r for p, q, r in zip(high, mid, low, strict=True)]
    y = n * z.astype(object) - np.array(rest, object)
    return (y * y).sum(1).tolist()


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: ``n`` vectors, sums, integer centre, eigenvectors
    (columns) with their eigenvalues, falling, and the trace."""

    n: int
    sums: list[int]
    centre: list[int]
    rest: list[int]            # sums - n * centre
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def covariance(n: int, rest: list[int], square: list[int]) -> tuple[np.ndarray, list[int]]:
    """The covariance matrix from the sums of squares; its entries times
    ``n * n`` are whole numbers and are rounded once, at the end."""
    dim = len(rest)
    own = [n * square[i] - rest[i] ** 2 for i in range(dim)]
    out, at = np.zeros((dim, dim)), dim
    for i in range(dim):
        out[i, i] = own[i] / (n * n)
        for j in range(i + 1, dim):
            both = n * square[at] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n * n)
            at += 1
    return out, own


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on all ``v`` of ``vectors`` (complete, of one length); None where there are none."""
    dim = vectors.select(F.size("v").alias("k")).agg(F.max("k")).first()[0] or 0
    if not dim:
        return None
    n, sums = _sums(vectors, column_sums, dim)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    middle = np.array(centre, np.int64)
    _, square = _sums(vectors, lambda x: squares(x - middle), dim * (dim + 1) // 2)
    v, own = covariance(n, rest, square)
    trace = sum(own) / (n * n)
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e, kind="stable")[:components]
    order = order[e[order] > NOTHING * trace] if trace > 0 else order[:0]
    return Whitening(n, sums, centre, rest, u[:, order], e[order], trace)


def project(model: Whitening, rows: DataFrame, keep: list[str]) -> DataFrame:
    """``rows`` (with ``v`` and the columns ``keep``) as ``keep``, ``deviation``
    (decimal, exact) and ``w``, the whitened components."""
    middle = np.array(model.centre, np.int64)
    off = np.array([r / model.n for r in model.rest])
    turn = model.vectors / np.sqrt(model.values)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            z = whole(b) - middle
            w = (z - off) @ turn
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            dev = [str(d) for d in square_norms(z, model.n, model.rest)]
            yield batch([*keep, "deviation", "w"], [*[b.column(c) for c in keep], pa.array(dev, pa.string()), lists])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep) + ", deviation string, w array<double>"
    return rows.select(*keep, "v").mapInArrow(in_task(run), schema)


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened leading components of every vector: ``(id, component, n,
    deviation, whitened, explained, identity_error)``.

    ``deviation`` is a string of digits, exact at any size; ``identity_error``
    is the largest absolute entry of the covariance of all ``whitened`` minus
    the identity.  Vectors that are null, empty, or hold null or non-finite
    entries (or entries whose ``x`` would need 62 bits or more) take no part;
    of several lengths the most frequent one does (of equals the longest).
    Null and repeated ids are rows like others.  Directions without variance
    cannot be whitened and are left out: one vector alone, or equal vectors
    only, give no row, as does an empty table.  Other columns are not read.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), entries(F.col(vec_col)).alias("v")).where(F.size("v") > 0)
    sizes = rows.groupBy(F.size("v").alias("k")).agg(F.count(F.lit(1)).alias("c"))
    length = sizes.agg(F.max(F.struct("c", "k")).alias("m")).first()["m"]
    rows = rows.where(F.size("v") == (length["k"] if length else -1))
    model = fit(rows, components)
    shape = f"id {rows.schema['id'].dataType.simpleString()}, deviation string, w array<double>"
    empty = model is None or not len(model.values)
    done = df.sparkSession.createDataFrame([], shape) if empty else stage(project(model, rows, ["id"]), "whitened")
    k = 0 if empty else len(model.values)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    error = 0.0
    if pairs:
        cov = done.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
        error = max(abs(cov[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.values]) if pairs else F.array().cast("array<double>")
    each = done.select("id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return each.select(F.col("id").alias(id_col), (F.col("at") + 1).alias("component"),
                       F.lit(0 if empty else model.n).cast("bigint").alias("n"), "deviation", "whitened",
                       F.get(share, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"))


def digest(found: DataFrame) -> DataFrame:
    """``deviation`` as a long (null where a long cannot hold it)."""
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)").cast(T.LongType()))
