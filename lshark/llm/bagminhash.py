"""MinHash near-dedup with BagMinHash signatures (operator 4).

A text is the multiset of its five-word shingles; two texts are near copies if
their weighted Jaccard similarity (sum of minimum counts over sum of maximum
counts) is at least 0.8.

*Signatures.*  A shingle's weight axis is cut at 0, 1, 2, 4, 8, ...; each
level holds an independent Poisson process of points (time, component, place
on the level), seeded by shingle and level alone.  A text sees the points that
lie below its own weight of the shingle, so a component's earliest point is
the same in two texts with probability equal to their weighted Jaccard
similarity.  Points are drawn in order of time only up to a horizon that
almost surely fills all components of a text; texts it does not fill are drawn
again with twice the horizon.

*Candidates.*  Texts with equal shingle sequences are one class, and only a
class's representative goes on.  Signatures are cut into bands.  Every member
of a bucket is compared with the bucket's best connected one, and links join
components.  What is left are buckets whose members are still in different
components: strays there are compared with all members of other components,
pair by pair in buckets of up to ``PAIRED`` members, and in larger ones within
tasks that hold a chunk of members as an inverted index and let strays pass.
So every link between components is found, no bucket is squared and none has
to fit a task.

*Verification* counts both texts' shingles exactly (64-bit shingle hashes).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lshark.llm import hashing
from lshark.llm.common import batch, id_back, id_key, in_task, ints, keyed_texts, ship, stage, text_bytes
from lshark.llm.components import components
from lshark.llm.hashing import U, mix

SHINGLE = 5
COMPONENTS = 64
BANDS = 16
THRESHOLD = 0.8
#: One-bit signatures of texts at the threshold differ in 6.4 of 64 bits (standard
#: deviation 2.4); more than 20 has a probability below one in a million.
MAX_BITS = 20
PAIRED = 64                  # members of a bucket up to which pairs are formed
CHUNK = 256                  # members of a larger bucket held at once
PART = 1 << 18              # words signed at once
PAIRS = 64                  # pairs verified at once


def shingles(units: np.ndarray, off: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, text)`` of all shingles; a text of fewer than ``k`` words but
    at least one has a single shingle of them all."""
    n = np.diff(off)
    p = hashing.Prefix(units)
    grams = p.grams(k)
    count = np.maximum(n - k + 1, 0)
    text = np.repeat(np.arange(len(n)), count)
    at = np.arange(len(text)) + np.repeat(off[:-1] - (np.cumsum(count) - count), count)
    short = np.flatnonzero((n > 0) & (n < k))
    return (np.concatenate((grams[at], p.ranges(off[short], off[short + 1]))),
            np.concatenate((text, short)))


def weights(h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``(text, hash)`` with counts."""
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return h[at], text[at], np.diff(np.append(at, len(h)))


def _draw(h, text, w, n_texts, horizon, m):
    """Earliest point per text and component up to each text's horizon."""
    sig = np.full(n_texts * m, np.inf)
    level = 0
    while len(h):
        # level 0 is [0, 1), level k is [2**(k-1), 2**k): its process has that rate
        low, rate = (0, 1) if level == 0 else (1 << (level - 1), 1 << (level - 1))
        in_level = w > low
        h, text, w = h[in_level], text[in_level], w[in_level]
        state = mix(h ^ U((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        t, owner, weight, x = np.zeros(len(h)), text, w, state.copy()
        while len(x):
            x = x + U(0x9E3779B97F4A7C15)
            r = mix(x.copy())
            t = t - np.log(((r >> U(11)).astype(np.float64) + 0.5) / (1 << 53)) / (rate * m)
            go = t <= horizon[owner]
            t, owner, weight, x = t[go], owner[go], weight[go], x[go]
            r = mix(r[go] ^ U(0xD1B54A32D192ED03))
            place = low + (r >> U(40)).astype(np.int64) * rate // (1 << 24)
            hit = place < weight                   # the point lies below this text's weight
            np.minimum.at(sig, owner[hit] * m + (r[hit] & U(m - 1)).astype(np.int64), t[hit])
        level += 1
    return sig.reshape(n_texts, m)


def signatures(h: np.ndarray, text: np.ndarray, w: np.ndarray, n_texts: int, m: int = COMPONENTS) -> np.ndarray:
    """BagMinHash signatures (times of the earliest points); texts without
    shingles have infinite components."""
    total = np.bincount(text, w, n_texts)
    horizon = np.divide(np.log(m) + 3, total, out=np.zeros(n_texts), where=total > 0)
    sig = _draw(h, text, w, n_texts, horizon, m)
    open_ = np.flatnonzero(np.isinf(sig).any(axis=1) & (total > 0))
    while len(open_):
        horizon[open_] *= 2
        number = np.full(n_texts, -1)
        number[open_] = np.arange(len(open_))
        k = number[text] >= 0
        sig[open_] = _draw(h[k], number[text[k]], w[k], len(open_), horizon[open_], m)
        open_ = open_[np.isinf(sig[open_]).any(axis=1)]
    return sig


def _value(sig: np.ndarray) -> np.ndarray:
    """Component values as integers; single precision hides differences in the
    last digit of a logarithm between machines."""
    return sig.astype(np.float32).view(np.uint32).astype(U)


def band_hashes(sig: np.ndarray, bands: int) -> np.ndarray:
    """One hash per text and band."""
    bits = mix(_value(sig)).reshape(len(sig), bands, -1)
    out = np.zeros(bits.shape[:2], U)
    for k in range(bits.shape[2]):
        out = out * U(0x9E3779B97F4A7C15) + bits[:, :, k]
    return mix(out)


def one_bit(sig: np.ndarray) -> np.ndarray:
    """One bit per component, packed into a word."""
    bits = mix(_value(sig) ^ U(0x2545F4914F6CDD1D)) >> U(63)
    return (bits << np.arange(sig.shape[1], dtype=U)).sum(axis=1, dtype=U)


def signed_texts(texts: DataFrame, k: int = SHINGLE, bands: int = BANDS, m: int = COMPONENTS) -> DataFrame:
    """``(d, f, g1, g2, size, bits, bands)``: class key (hashes of the word
    sequence), shingle count, one-bit signature and band hashes.  Texts
    without words have ``size`` 0 and no bands."""
    def run(batches):
        for b in batches:
            d, f = ints(b.column("d")), ints(b.column("f"))
            buf, boff = text_bytes(b.column("text"))
            units, off = hashing.word_hashes(buf, boff)
            for i, j, s, e in hashing.segments(off, 1, PART):
                if (s, e) != (off[i], off[j]):         # a very long text comes whole, once
                    if s != off[i]:
                        continue
                    e = int(off[j])
                part, cut = units[s:e], off[i:j + 1] - s
                h, text = shingles(part, cut, k)
                size = np.bincount(text, minlength=j - i)
                h, text, w = weights(h, text)
                sig = signatures(h, text, w, j - i, m)
                p = hashing.Prefix(mix(part ^ U(0x6A09E667F3BCC909)))
                g1 = hashing.Prefix(part).ranges(cut[:-1], cut[1:])
                g2 = p.ranges(cut[:-1], cut[1:])
                hashes = band_hashes(sig, bands).view(np.int64)
                step = np.where(size > 0, bands, 0)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(step))).astype(np.int32)),
                                                 pa.array(hashes[size > 0].ravel()))
                yield batch(["d", "f", "g1", "g2", "size", "bits", "bands"],
                            [d[i:j], f[i:j], g1.view(np.int64), g2.view(np.int64), size,
                             one_bit(sig).view(np.int64), lists])

    return texts.mapInArrow(in_task(run), "d long, f long, g1 long, g2 long, size long, bits long, bands array<long>")


def tokens(h: np.ndarray, text: np.ndarray, n_texts: int) -> list[np.ndarray]:
    """Each text's multiset of shingles as a sorted set: repeats get marks of their own."""
    h, text, w = weights(h, text)
    again = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
    t = mix(np.repeat(h, w) + again.astype(U) * U(0xC2B2AE3D27D4EB4F))
    text = np.repeat(text, w)
    t = t[np.lexsort((t, text))]
    return np.split(t, np.cumsum(np.bincount(text, minlength=n_texts))[:-1])


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity from the tokens of two texts."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    total = len(a) + len(b) - both
    return both / total if total else 0.0


def _blobs(column) -> list[np.ndarray]:
    buf, off = text_bytes(column)
    raw = buf.tobytes()
    return [np.frombuffer(raw[s:e], U) for s, e in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]


def token_table(texts: DataFrame, k: int) -> DataFrame:
    """``(r, tokens)`` of ``(r, text)``."""
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, PAIRS):
                b = whole.slice(at, PAIRS)
                units, off = hashing.word_hashes(*text_bytes(b.column("text")))
                found = tokens(*shingles(units, off, k), b.num_rows)
                yield batch(["r", "tokens"], [b.column("r"), pa.array([t.tobytes() for t in found], pa.binary())])

    return texts.select("r", "text").mapInArrow(in_task(run), "r long, tokens binary")


def verified(pairs: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``(a, b)`` of representatives whose tokens overlap enough."""
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, PAIRS):
                b = whole.slice(at, PAIRS)
                good = [overlap(x, y) >= threshold for x, y in
                        zip(_blobs(b.column("x")), _blobs(b.column("y")), strict=True)]
                yield batch(["a", "b"], [b.column("a"), b.column("b")]).filter(pa.array(good, pa.bool_()))

    # the same plan at every size: tokens and pairs are shuffled, none is a broadcast side
    one = pairs.join(known.select(F.col("r").alias("a"), F.col("tokens").alias("x")).hint("merge"), "a")
    two = one.join(known.select(F.col("r").alias("b"), F.col("tokens").alias("y")).hint("merge"), "b")
    return two.select("a", "b", "x", "y").mapInArrow(in_task(run), "a long, b long")


class _Members:
    """A chunk of a bucket's members as an inverted index of their tokens."""

    def __init__(self, rows: list[tuple]):
        self.r, self.component = (np.array([x[k] for x in rows], np.int64) for k in (0, 1))
        self.size = np.array([len(x[2]) for x in rows])
        t, owner = np.concatenate([x[2] for x in rows]), np.repeat(np.arange(len(rows)), self.size)
        order = np.argsort(t)
        self.t, self.owner = t[order], owner[order]

    def links(self, component: int, found: np.ndarray, threshold: float) -> np.ndarray:
        """One member of each other component that the tokens overlap enough with."""
        lo, hi = np.searchsorted(self.t, found, "left"), np.searchsorted(self.t, found, "right")
        n = hi - lo
        at = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
        both = np.bincount(self.owner[at], minlength=len(self.r))
        near = np.flatnonzero((both >= threshold * (self.size + len(found) - both)) & (self.component != component))
        return self.r[near[np.unique(self.component[near], return_index=True)[1]]]


def large_bucket_links(members: DataFrame, known: DataFrame, threshold: float, n: int) -> DataFrame:
    """Links ``(a, b)`` between components inside large buckets, from rows
    ``(band, v, r, component, main)``."""
    def run(batches):
        key, rows, held = None, [], None
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("band", "v", "chunk", "role", "r", "component")]
            out = []
            for band, v, chunk, role, r, component, t in zip(*cols, _blobs(b.column("tokens")), strict=True):
                if (band, v, chunk) != key:
                    key, rows, held = (band, v, chunk), [], None
                if role == 0:
                    rows.append((r, component, t))
                elif rows:
                    held = held or _Members(rows)
                    out += [(r, int(x)) for x in held.links(component, t, threshold)]
            if out:
                yield batch(["a", "b"], [pa.array(x, pa.int64()) for x in zip(*out, strict=True)])

    sizes = stage(members.groupBy("band", "v").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")), "chunks", n)
    rows = members.join(sizes, ["band", "v"])
    held = rows.withColumn("chunk", F.pmod(F.xxhash64("r"), F.col("chunks")).cast("int")).withColumn("role", F.lit(0))
    pass_by = (rows.where("component != main").withColumn("role", F.lit(1))
               .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))))
    cols = ["band", "v", "chunk", "role", "r", "component"]
    both = held.select(*cols).unionByName(pass_by.select(*cols)).join(known, "r")
    return (both.repartition("band", "v", "chunk").sortWithinPartitions("band", "v", "chunk", "role")
            .select(*cols, "tokens").mapInArrow(in_task(run), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Class of every row: ``(id, class_id, kept)``; ``how`` as in :func:`classes`.

    ``class_id`` is the smallest id that links of similarity ``threshold`` or
    more reach, ``kept`` marks that document (of rows repeating that id with
    one text all are marked; :func:`keep_one` drops such repeats).  Null,
    empty and word-free texts are in no group: each is its own class and kept.
    A null id comes before all others.  An empty table gives an empty result.
    """
    out = classes(docs, id_col, text_col, **how)
    return out.select(id_back(F.col("d")).alias(id_col), id_back(F.col("class_id")).alias("class_id"),
                      ((F.col("d") == F.col("class_id")) & (F.col("turn") == 0)).alias("kept"))


def bucket_members(reps: DataFrame, n: int) -> DataFrame:
    """Texts in buckets of two or more: ``(r, d, f, size, bits, degree,
    buckets)``, ``buckets`` their ``(band, v, n)`` with ``n`` members and
    ``degree`` the sum of these; a row per text, of ``n`` at most."""
    rows = reps.select("r", "d", "f", "size", "bits", F.posexplode("bands").alias("band", "v"))
    counts = stage(rows.groupBy("band", "v").agg(F.count("*").alias("n")).where("n > 1"), "bucket-counts", n)
    each = (rows.join(counts, ["band", "v"]).groupBy("r", "d", "f", "size", "bits")          # at most one bucket per band
            .agg(F.sum("n").alias("degree"), F.collect_list(F.struct("band", "v", "n")).alias("buckets")))
    return stage(each, "bucket-members", n)


def stray_links(rows: DataFrame, found: DataFrame, known: DataFrame, threshold: float, near, n: int) -> DataFrame | None:
    """Links ``(a, b)`` between members of one bucket that are still in
    different components; None where there are none to compare."""
    placed = stage(rows.join(found.withColumnRenamed("node", "r"), "r", "left").withColumn(
        "component", F.coalesce("component", "r")), "placed", n)
    sizes = placed.groupBy("band", "v", "component").agg(F.count("*").alias("k"))
    main = (sizes.groupBy("band", "v").agg(F.max(F.struct("k", "component")).alias("top"), F.count("*").alias("parts"))
            .where("parts > 1").select("band", "v", F.col("top.component").alias("main")))
    apart = stage(placed.join(stage(main, "bucket-main", n), ["band", "v"]), "apart", n)
    largest = apart.agg(F.max("n")).first()[0]
    if largest is None:
        return None
    few = apart.where(F.col("n") <= PAIRED)
    x, y = few.where("component != main").alias("x"), few.alias("y")
    # strays against the largest component, and strays of different components once
    differ = (F.col("x.component") != F.col("y.component")) & (
        (F.col("y.component") == F.col("y.main")) | (F.col("x.component") < F.col("y.component")))
    rest = stage(x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.v") == F.col("y.v")) & differ & near)
                 .select(F.least("x.r", "y.r").alias("a"), F.greatest("x.r", "y.r").alias("b")).distinct(), "stray-pairs", n)
    more = verified(rest, known, threshold)
    if largest > PAIRED:
        members = apart.where(F.col("n") > PAIRED).select("band", "v", "r", "component", "main")
        more = more.unionByName(large_bucket_links(members, known, threshold, n))
    more = stage(more, "more-links", n)
    return None if more.isEmpty() else more


def classes(docs: DataFrame, id_col: str, text_col: str, k: int = SHINGLE, threshold: float = THRESHOLD,
            bands: int = BANDS, m: int = COMPONENTS, max_bits: int | None = MAX_BITS) -> DataFrame:
    """``(d, f, class_id, turn)`` per row; ``turn`` is 0 for the text that
    represents its id (other texts of a repeated id have 1).  Pairs whose
    one-bit signatures differ in more than ``max_bits`` are not verified; None
    verifies all."""
    ship(docs.sparkSession)
    texts = keyed_texts(docs, id_col, text_col)
    signed = stage(signed_texts(texts, k, bands, m), "signed")
    n = signed.count()
    worded = signed.where("size > 0")
    # equal word sequences: one representative row (d, f) per class
    heads = stage(worded.groupBy("g1", "g2").agg(F.min(F.struct("d", "f")).alias("head")), "heads", n)
    # a class's number: its smallest id, and for the case of one id with several texts the fingerprint
    member = worded.select("d", "f", "g1", "g2").join(heads, ["g1", "g2"]).select("d", "f", "head")
    reps = (worded.join(heads.select("g1", "g2", "head.*"), ["g1", "g2", "d", "f"])
            .dropDuplicates(["d", "f"]).select(F.xxhash64("d", "f").alias("r"), "d", "f", "size", "bits", "bands"))
    reps = stage(reps, "reps", n)
    members = bucket_members(reps, n)
    rows = members.select("r", "size", "bits", "degree", F.inline("buckets"))
    # a bucket's centre is its member with the most bucket neighbours: copies of
    # one original meet it more often than each other
    centres = stage(rows.groupBy("band", "v").agg(F.max(F.struct("degree", "r", "size", "bits")).alias("y")), "centres", n)
    # texts are shuffled once, at every size
    known = texts.join(members.select("d", "f", "r").hint("merge"), ["d", "f"]).dropDuplicates(["d", "f"])
    known = stage(token_table(known, k), "bucket-tokens", n)

    near = F.least("x.size", "y.size") >= threshold * F.greatest("x.size", "y.size")
    if max_bits is not None:
        near = near & (F.bit_count(F.col("x.bits").bitwiseXOR(F.col("y.bits"))) <= max_bits)
    star = stage(rows.alias("x").join(centres, ["band", "v"]).where((F.col("x.r") != F.col("y.r")) & near)
                 .select(F.col("y.r").alias("a"), F.col("x.r").alias("b")).distinct(), "star-pairs", n)
    joined = components(stage(verified(star, known, threshold), "links", n))
    more = stray_links(rows, joined, known, threshold, near, n)
    if more is not None:                                    # they join components, so only these are gone through
        name = joined.withColumnRenamed("component", "c")
        for end in ("a", "b"):
            more = (more.join(name.withColumnRenamed("node", end), end, "left")
                    .withColumn(end, F.coalesce("c", end)).drop("c"))
        top = components(stage(more, "component-links", n))
        all_nodes = joined.unionByName(top.select("node", F.col("node").alias("component"))
                                       .join(joined.select("node"), "node", "left_anti"))
        joined = (all_nodes.join(top.select(F.col("node").alias("component"), F.col("component").alias("c")), "component", "left")
                  .select("node", F.coalesce("c", "component").alias("component")))

    # back to documents: a component's class is its smallest member
    lowest = stage(reps.join(joined.withColumnRenamed("node", "r"), "r").select("component", "d", "f"), "component-members", n)
    best = stage(lowest.groupBy("component").agg(F.min(F.struct("d", "f")).alias("best")), "component-heads", n)
    moved = lowest.join(best, "component").select(F.struct("d", "f").alias("head"), "best")
    final = member.join(stage(moved, "moved", n), "head", "left").withColumn("best", F.coalesce("best", "head"))
    same = F.struct("d", "f") == F.col("best")
    out = final.select("d", "f", F.col("best.d").alias("class_id"),
                       F.when(same, 0).otherwise(1).alias("turn"))
    none = signed.where("size = 0").select("d", "f", F.col("d").alias("class_id"), F.lit(0).alias("turn"))
    return out.unionByName(none)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents with one of each group kept, all columns and their names
    as they were.  Of rows that repeat both id and text one is kept.  Null,
    empty and word-free texts are in no group; an empty table gives an empty
    result."""
    found = classes(docs, id_col, text_col, **how).where("(d = class_id) and turn = 0")
    found = stage(found.select("d", "f").distinct(), "kept", docs.count())
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(id_key(F.col(id_col)).alias("d"), F.xxhash64(text).alias("f"), F.struct("*").alias("row"))
    kept = keyed.join(found, ["d", "f"], "left_semi").dropDuplicates(["d", "f"])
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
