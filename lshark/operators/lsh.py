"""MinHash LSH on the long form ``(u, i)``: signatures (D2), buckets (D3),
candidates (D4), similarity join (D5), nearest neighbours (D6, D7), exact
Jaccard join (D8) and the recall report (D9).

Design notes (scale):

* Signatures are ``groupBy(u).agg(min(hash_t(i)))`` — a hash aggregate with a
  map-side partial step, so an entity holding a large share of the rows never
  lands in one task and no per-entity array is built to hash it.
* Pairs are produced by equi-joins on a group key (a bucket, or a prefix
  token).  Groups larger than ``block_size`` members are split into blocks and
  joined block-pair by block-pair, so a hot group is spread over many tasks
  instead of being squared inside one.  The table of hot groups is broadcast
  only after its row count has been checked.
* A distance threshold adds the lossless size bound
  ``min(n_a, n_b) / max(n_a, n_b) >= 1 - threshold`` to the join condition.
* Sets over few distinct elements share groups with nearly all others; where the
  counted pairs of the groups cost more, two sets are met block by block as rows
  of bits (:mod:`lshark.operators.dense`).
* With a threshold, candidates may come from exact prefix filtering instead
  of buckets; pairs that share no bucket are then dropped by comparing the two
  signatures position by position, so the result is exactly the LSH answer.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lshark.functions.minhash import MinHashModel
from lshark.operators import dense
from lshark.session import cut_lineage, ship

DEFAULT_BLOCK = 2048           # members per block when a group is split
PREFIX_ALWAYS = 0.5            # distance thresholds up to this use prefix filtering
BIG_SET = 50_000               # sets larger than this are never gathered into one row
PAIRS_PER_PARTITION = 1_000_000  # target pair work per task in pair joins
MOST_BLOCKS = 16               # blocks a group is cut into at most: a row is copied no more often than that
MOST_PARTITIONS = 2000         # tasks of a pair join at most: more would write shuffle blocks of a few bytes
PLAN_PAIRS = 5_000_000         # bucket pairs of two tables from which the other route is counted as well
SMALL_SET = 16                 # pairs of sets this short are checked inside the pair join
BROADCAST_ROWS = 2_000_000     # hot-group rows we allow to broadcast (3 longs each)
INDEX_ROWS = 100_000           # group rows of a smaller side that we allow to broadcast (at most about 600 bytes each)
EARLIER = 16                   # prefixes up to this length carry their earlier tokens, so pairs meet once
SLICE_BYTES = 256 << 20        # bytes of sets or bit maps sent along with pairs at once, or as many as all sets have
MOST_SLICES = 64
SENT_IDS = 1_000_000           # ids of the sets to be fetched that we allow to broadcast (a long each)
CLASSES = 6                    # classes of token weights to a doubling
SLOT_BITS = (16, 24)           # fewest and most slots of the table of weight classes, a byte each, as powers of two
SORTED = 1 << 20               # elements of sets that are sorted at a time
MAP_WORDS = 16                 # 64-bit words of a set's bit map, by which candidates go before their sets are fetched
_EPS = 1e-9


# ---------------------------------------------------------------- signatures

def signatures(inter: DataFrame, model: MinHashModel) -> DataFrame:
    """``(u, n, hashes)`` for distinct ``(u, i)`` rows (D2).

    ``n`` is the set size; entities without elements simply have no row (an
    empty set has no MinHash, Spark ML raises on it).
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.min(model.hash_col(F.col("i"), t)).alias(f"_h{t}") for t in range(model.num_tables)]
    return (inter.groupBy("u").agg(*aggs)
                 .select("u", "n", F.array(*[F.col(f"_h{t}") for t in range(model.num_tables)]).alias("hashes")))


def profiles(inter: DataFrame, model: MinHashModel | None = None) -> DataFrame:
    """``(u, n, items[, hashes])`` in one aggregation: what verification needs."""
    aggs = [F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("i")).alias("items")]
    if model is not None:
        aggs += [F.min(model.hash_col(F.col("i"), t)).alias(f"_h{t}") for t in range(model.num_tables)]
    out = inter.groupBy("u").agg(*aggs)
    cols = ["u", "n", "items"]
    if model is not None:
        cols.append(F.array(*[F.col(f"_h{t}") for t in range(model.num_tables)]).alias("hashes"))
    return out.select(*cols)


def buckets(sig: DataFrame, with_hashes: bool = False) -> DataFrame:
    """One row per (entity, table): ``(u, n, tb, hv)`` (D3).

    ``with_hashes`` keeps the whole signature on each row, which lets the
    candidate join emit a pair only at its first shared table (no dedupe).
    """
    extra = ["hashes"] if with_hashes else []
    return sig.select("u", "n", *extra, F.posexplode("hashes").alias("tb", "hv"))


# ------------------------------------------------- pairs inside equal groups

def least_similarity(threshold: float) -> float:
    """Similarity from which pairs of distance below ``threshold`` are found."""
    return max(0.0, 1.0 - threshold - _EPS)


def _size_bound(n_l: Column, n_r: Column, t: Column) -> Column:
    """Sets of similarity ``t`` or more have sizes within that ratio."""
    return F.least(n_l, n_r).cast("double") >= (t - F.lit(_EPS)) * F.greatest(n_l, n_r)


def _needed(t: Column) -> Column:
    """Overlap that the sets ``l`` and ``r`` need for similarity ``t``."""
    return F.ceil(t / (F.lit(1.0) + t) * (F.col("l.n") + F.col("r.n")).cast("double") - F.lit(1e-6))


def _positional_bound(t: Column) -> Column:
    """PPJoin's positional filter for a pair meeting on a prefix token.

    At the pair's first common token (positions ``i``, ``j``, 1-based) the
    overlap is at most ``1 + min(n_a - i, n_b - j)``; Jaccard ``>= t`` needs
    overlap ``>= t / (1 + t) * (n_a + n_b)``.  Later common tokens may fail
    the bound, but the first one never does for a qualifying pair, so rows
    failing it can be dropped inside the join without losing a pair.
    """
    return F.lit(1) + F.least(F.col("l.n") - F.col("l.pos"), F.col("r.n") - F.col("r.pos")) >= _needed(t)


def _short_sets_overlap(t: Column) -> Column:
    """The exact overlap test of pairs whose sets ride along on the rows: false
    candidates go inside the join, before any pair is shuffled."""
    return (F.col("l.items").isNull() | F.col("r.items").isNull()
            | (F.size(F.array_intersect(F.col("l.items"), F.col("r.items"))) >= _needed(t)))


def _first_shared_token() -> Column:
    """True unless two prefixes also meet on an earlier token: a pair is then
    emitted once.  Prefixes too long to carry their earlier tokens (null) are
    not told apart here."""
    return F.coalesce(~F.arrays_overlap(F.col("l.pre"), F.col("r.pre")), F.lit(True))


def group_stats(rows: DataFrame, keys: list[str], block_size: int = DEFAULT_BLOCK) -> tuple[int, int]:
    """``(pairs, hot)``: sum of ``m(m-1)/2`` over groups (the pair work a
    group join would do) and the number of groups above ``block_size``.
    One aggregation; both numbers are scalars."""
    g = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"))
    r = g.agg(F.sum(F.col("_m") * (F.col("_m") - 1) / 2).alias("p"),
              F.count(F.when(F.col("_m") > block_size, 1)).alias("h")).first()
    return int(r["p"] or 0), int(r["h"] or 0)


def pair_partitions(spark, est_pairs: int) -> int:
    """Partitions for a pair-producing stage, from its pair estimate.

    AQE sizes shuffle partitions by their *input* bytes; a group join's
    output is quadratic in its input, so a few MB of bucket rows can carry
    millions of pairs and would be coalesced into one task.  The explicit
    count (never coalesced) keeps about ``PAIRS_PER_PARTITION`` pairs per
    task up to :data:`MOST_PARTITIONS` tasks, and never fewer partitions than
    the session default.
    """
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(base, min(-(-int(est_pairs) // PAIRS_PER_PARTITION), MOST_PARTITIONS))


def _hot_table(rows: DataFrame, keys: list[str], block_size: int, n_hot: int) -> DataFrame:
    hot = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"))
               .where(F.col("_m") > block_size)
               .select(*keys, F.ceil(F.col("_m") / F.lit(block_size)).cast("int").alias("_S")))
    return F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot


def _first_shared_table(num_tables: int) -> Column:
    """True when the row's table ``tb`` is the first table on which the two
    signatures agree, so each candidate pair is emitted exactly once."""
    return reduce(lambda x, y: x & y, [
        (F.lit(t) >= F.col("l.tb")) | (F.col("l.hashes")[t] != F.col("r.hashes")[t])
        for t in range(num_tables)])


def _group_join(rows: DataFrame, keys: list[str], threshold: float | None, block_size: int,
                carry: list[str], stats: tuple[int, int] | None = None,
                num_tables: int = 0, out_cols: list[str] | None = None, extra: list[Column] = (),
                out_more: dict[str, Column] | None = None) -> DataFrame:
    """Self join of ``rows`` on ``keys``; every unordered pair of distinct
    members meets once per shared group.  Output ``a < b`` plus
    ``<c>_a`` / ``<c>_b`` for each carried column (``n`` always carried).
    ``extra`` are more conditions and ``out_more`` more columns over the sides
    ``l`` and ``r``.

    Groups above ``block_size`` members are cut into ``S`` hash blocks; a
    member of block ``p`` goes to block pairs ``(p, q>=p)`` on the left and
    ``(q<=p, p)`` on the right, so no task squares a whole hot group.  ``S`` is
    :data:`MOST_BLOCKS` at most: the rows shuffled stay in proportion to the input.
    ``stats`` is ``group_stats(rows, keys, block_size)`` when already known.
    """
    cols = list(dict.fromkeys(["n"] + carry))
    rows = rows.select(*keys, "u", *cols)
    est, n_hot = stats if stats is not None else group_stats(rows, keys, block_size)
    nparts = pair_partitions(rows.sparkSession, est)
    if n_hot == 0:
        rows = rows.repartition(nparts, *keys)
        l, r = rows.alias("l"), rows.alias("r")
        cond = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys] + [F.col("l.u") < F.col("r.u")]
    else:
        hot = _hot_table(rows, keys, block_size, n_hot)
        blocked = (rows.join(hot, keys, "left")
                       .withColumn("_S", F.least(F.coalesce(F.col("_S"), F.lit(1)), F.lit(MOST_BLOCKS)))
                       .withColumn("_blk", F.pmod(F.xxhash64("u"), F.col("_S")).cast("int")))
        left = blocked.select(*keys, "u", *cols, F.col("_blk").alias("_p"),
                              F.explode(F.sequence(F.col("_blk"), F.col("_S") - 1)).alias("_q"))
        right = blocked.select(*keys, "u", *cols,
                               F.explode(F.sequence(F.lit(0), F.col("_blk"))).alias("_p"),
                               F.col("_blk").alias("_q"))
        l = left.repartition(nparts, *keys, "_p", "_q").alias("l")
        r = right.repartition(nparts, *keys, "_p", "_q").alias("r")
        cond = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys + ["_p", "_q"]]
        cond.append(((F.col("l._p") < F.col("l._q")) & (F.col("l.u") != F.col("r.u")))
                    | (F.col("l.u") < F.col("r.u")))
    if "hashes" in cols and keys == ["tb", "hv"]:
        cond.append(_first_shared_table(num_tables))
    if threshold is not None and threshold < 1.0:
        t = F.lit(least_similarity(threshold))
        cond.append(_size_bound(F.col("l.n"), F.col("r.n"), t))
        if "pos" in cols:
            cond.append(_positional_bound(t))
        if "items" in cols:
            cond.append(_short_sets_overlap(t))
    if "pre" in cols:
        cond.append(_first_shared_token())
    cond += extra
    lo = F.col("l.u") < F.col("r.u")
    out = [F.least("l.u", "r.u").alias("a"), F.greatest("l.u", "r.u").alias("b")]
    for c in (cols if out_cols is None else out_cols):
        out.append(F.when(lo, F.col(f"l.{c}")).otherwise(F.col(f"r.{c}")).alias(f"{c}_a"))
        out.append(F.when(lo, F.col(f"r.{c}")).otherwise(F.col(f"l.{c}")).alias(f"{c}_b"))
    out += [c.alias(name) for name, c in (out_more or {}).items()]
    return l.join(r, reduce(lambda x, y: x & y, cond)).select(*out)


def _distinct_pairs(found: DataFrame, all_once: bool) -> DataFrame:
    """``(a, b)`` once each, of ``(a, b, once)``: only pairs that may have been
    emitted more than once are deduplicated."""
    if all_once:
        return found.select("a", "b")
    found = cut_lineage(found, "met-pairs")
    return found.where("once").select("a", "b").unionByName(found.where("NOT once").select("a", "b").distinct())


def pairs_in_groups(rows: DataFrame, keys: list[str], threshold: float | None = None,
                    block_size: int = DEFAULT_BLOCK, stats: tuple[int, int] | None = None,
                    num_tables: int | None = None, all_once: bool = False) -> DataFrame:
    """Distinct ``(a, b)``, ``a < b``, of members sharing a group (self join).

    ``rows`` has ``keys`` + ``u`` (member) + ``n`` (set size) and, for prefix
    tokens, ``pos`` and ``pre``; with a threshold the size bound (and the
    positional bound when ``pos`` is given) is part of the join condition.
    Bucket rows carrying ``hashes`` emit each pair only at its first shared
    table and prefix rows carrying ``pre`` only at its first shared token, so
    these need no dedupe shuffle; ``all_once`` says that all prefix rows do.
    Other pairs are deduplicated.
    """
    carry = [c for c in ("pos", "pre", "hashes", "items") if c in rows.columns]
    first_only = "hashes" in carry and keys == ["tb", "hv"]
    tables = num_tables or 0
    if first_only and not tables:
        tables = rows.select(F.max(F.size("hashes"))).first()[0] or 0
    rows = rows.select(*keys, "u", "n", *carry)
    stats = stats if stats is not None else group_stats(rows, keys, block_size)
    once = {"once": F.col("l.pre").isNotNull() & F.col("r.pre").isNotNull()} if "pre" in carry else None
    pairs = _group_join(rows, keys, threshold, block_size, carry, stats, tables, out_cols=[], out_more=once)
    if first_only:
        return pairs.select("a", "b")
    return _distinct_pairs(pairs, all_once) if once else pairs.distinct()


def across_stats(lrows: DataFrame, rrows: DataFrame, keys: list[str], block_size: int = DEFAULT_BLOCK) -> dict:
    """Pair work of a join between two tables of group rows: ``pairs``, the rows
    of each side and the number of groups above ``block_size`` on a side
    (scalars, one aggregation), and ``groups``, the counted groups."""
    groups = (lrows.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
              .unionByName(rrows.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
              .groupBy(*keys).agg(F.sum("_l").alias("_ml"), F.sum("_r").alias("_mr")))
    hot = (F.col("_ml") > block_size) | (F.col("_mr") > block_size)
    st = groups.agg(F.sum(F.col("_ml") * F.col("_mr")).alias("p"), F.sum("_ml").alias("l"), F.sum("_mr").alias("r"),
                    F.count(F.when(hot, 1)).alias("h")).first()
    return {"pairs": int(st["p"] or 0), "left": int(st["l"] or 0), "right": int(st["r"] or 0), "hot": int(st["h"] or 0),
            "groups": groups.where(hot)}


def _across_join(lrows: DataFrame, rrows: DataFrame, keys: list[str], cond: list[Column], out: list[Column],
                 block_size: int, stats: dict) -> DataFrame:
    """Join two tables of group rows on ``keys`` under ``cond``, over the sides
    ``l`` and ``r``.  A smaller side of counted size is sent to all tasks as an
    index that the other side's rows probe where they are; otherwise groups
    above ``block_size`` on a side are cut into blocks, and each left block
    meets each right block in one task."""
    spark = lrows.sparkSession
    nparts = pair_partitions(spark, stats["pairs"])
    if min(stats["left"], stats["right"]) <= INDEX_ROWS:
        if stats["left"] <= stats["right"]:
            l, r = F.broadcast(lrows).alias("l"), rrows.repartition(nparts).alias("r")
        else:
            l, r = lrows.repartition(nparts).alias("l"), F.broadcast(rrows).alias("r")
        on = keys
    elif stats["hot"] == 0:
        l, r, on = lrows.repartition(nparts, *keys).alias("l"), rrows.repartition(nparts, *keys).alias("r"), keys
    else:
        def count(members):
            return F.least(F.greatest(F.ceil(F.col(members) / F.lit(block_size)), F.lit(1)), F.lit(MOST_BLOCKS)).cast("int")

        cnt = stats["groups"].select(*keys, count("_ml").alias("_SL"), count("_mr").alias("_SR"))
        hot = F.broadcast(cnt) if stats["hot"] <= BROADCAST_ROWS else cnt

        def blocked(rows, own, other, mine, theirs):
            rows = (rows.join(hot, keys, "left").withColumn(own, F.coalesce(own, F.lit(1)))
                    .withColumn(other, F.coalesce(other, F.lit(1))))
            return (rows.withColumn(mine, F.pmod(F.xxhash64("u"), F.col(own)).cast("int"))
                    .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("_SL", "_SR"))

        on = [*keys, "_p", "_q"]
        l = blocked(lrows, "_SL", "_SR", "_p", "_q").repartition(nparts, *on).alias("l")
        r = blocked(rrows, "_SR", "_SL", "_q", "_p").repartition(nparts, *on).alias("r")
    equal = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in on]
    return l.join(r, reduce(lambda x, y: x & y, equal + cond)).select(*out)


def pairs_across_groups(lrows: DataFrame, rrows: DataFrame, keys: list[str],
                        threshold: float | None = None, block_size: int = DEFAULT_BLOCK,
                        num_tables: int = 0, stats: dict | None = None, all_once: bool = False) -> DataFrame:
    """Distinct ``(a, b)`` with ``a`` from ``lrows`` and ``b`` from ``rrows``
    sharing a group; bucket rows with ``hashes`` meet at their first shared
    table only, prefix rows with ``pre`` at their first shared token, others
    are deduplicated."""
    first_only = bool(num_tables) and "hashes" in lrows.columns
    carry = ["hashes"] if first_only else [c for c in ("pos", "pre", "items") if c in lrows.columns]
    lrows, rrows = lrows.select(*keys, "u", "n", *carry), rrows.select(*keys, "u", "n", *carry)
    stats = stats or across_stats(lrows, rrows, keys, block_size)
    cond = []
    if first_only:
        cond.append(_first_shared_table(num_tables))
    if threshold is not None and threshold < 1.0:
        t = F.lit(least_similarity(threshold))
        cond.append(_size_bound(F.col("l.n"), F.col("r.n"), t))
        if "pos" in carry:
            cond.append(_positional_bound(t))
        if "items" in carry:
            cond.append(_short_sets_overlap(t))
    out = [F.col("l.u").alias("a"), F.col("r.u").alias("b")]
    if "pre" in carry:
        cond.append(_first_shared_token())
        out.append((F.col("l.pre").isNotNull() & F.col("r.pre").isNotNull()).alias("once"))
    found = _across_join(lrows, rrows, keys, cond, out, block_size, stats)
    if first_only:
        return found
    return _distinct_pairs(found, all_once) if "pre" in carry else found.distinct()


def candidates(bkt: DataFrame, threshold: float | None = None,
               block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """LSH candidate pairs: equal hash in at least one table (D4).  Bucket rows
    with whole signatures go block by block where nearly all sets share buckets."""
    if threshold is not None or "hashes" not in bkt.columns or bkt.schema["u"].dataType != T.LongType():
        return pairs_in_groups(bkt, ["tb", "hv"], threshold, block_size)
    stats = group_stats(bkt, ["tb", "hv"], block_size)
    size = F.size("hashes")
    st = bkt.agg(F.count(F.lit(1)).alias("rows"), F.count("hv").alias("hashed"), F.count("u").alias("keyed"),
                 F.count(F.when(F.col("tb") == 0, 1)).alias("sets"), F.min(size).alias("least"), F.max(size).alias("most")).first()
    whole = st["least"] == st["most"] and st["rows"] == st["hashed"] == st["keyed"] == st["sets"] * (st["most"] or 0)
    if whole and dense.cheaper(st["sets"] * (st["sets"] - 1) / 2, stats[0], 0):
        return dense.sharing_pairs(bkt.where("tb = 0"), st["sets"])
    return pairs_in_groups(bkt, ["tb", "hv"], threshold, block_size, stats, st["most"])


# ------------------------------------------------------- prefix filtering

def big_entities(inter: DataFrame, big_set: int = BIG_SET) -> DataFrame:
    """Entities with more than ``big_set`` elements, ``(u, n)``.

    Their number is at most ``rows / big_set``; it is counted before the
    list is broadcast, and a shuffle join is used beyond ``BROADCAST_ROWS``.
    """
    return (inter.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
                 .where(F.col("n") > big_set))


def entity_stats(inter: DataFrame, big_set: int = BIG_SET) -> tuple[tuple[DataFrame, int], int, int]:
    """``((big, n_big), smallest, largest)`` from one aggregation of set sizes:
    the big entities (broadcast when their count allows), the smallest set's
    size and the size of the largest set that is not big."""
    sizes = inter.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    is_big = F.col("n") > big_set
    r = sizes.agg(F.min("n").alias("mn"), F.max(F.when(~is_big, F.col("n"))).alias("mx"),
                  F.count(F.when(is_big, 1)).alias("nb")).first()
    n_big = int(r["nb"] or 0)
    big = sizes.where(is_big)
    return ((F.broadcast(big) if n_big <= BROADCAST_ROWS else big), n_big), int(r["mn"] or 0), int(r["mx"] or 0)


def prefix_length(n, t):
    """Tokens of a set of ``n`` that a set of similarity ``t`` must meet: columns or numbers."""
    if isinstance(n, Column):
        return n - F.ceil(n * t) + 1
    return n - math.ceil(n * t) + 1


def meets_once(threshold: float, largest: int, n_big: int) -> bool:
    """Whether every prefix is short enough to carry its earlier tokens."""
    return n_big == 0 and prefix_length(largest, least_similarity(threshold)) <= EARLIER


def _with_short_sets(rows: DataFrame, inter: DataFrame, smallest: int) -> DataFrame:
    """Group rows with the elements (``items``) of every set of at most
    ``SMALL_SET``; longer sets have null.  Whether a pair is checked early
    depends on its own two sets alone."""
    if smallest > SMALL_SET:
        return rows                                            # no set is short
    short = rows.where(F.col("n") <= SMALL_SET).select("u").distinct()
    items = (inter.join(short, "u", "left_semi").groupBy("u")
             .agg(F.array_sort(F.collect_list("i")).alias("items")))
    return rows.join(items, "u", "left")


def _bounded_broadcast(df: DataFrame) -> tuple[DataFrame, int]:
    n = df.count()
    return (F.broadcast(df) if n <= BROADCAST_ROWS else df), n


def _slots(tokens: np.ndarray, bits: int) -> np.ndarray:
    return ((tokens.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _weight_classes(freq: DataFrame) -> Broadcast:
    """The weights ``(i, _w)`` of all tokens as a table of bytes: at a token's
    slot lies the largest class of weight of the tokens there, 0 where none
    weighs.  It stands for a join on the token: 16 MB at most pass the driver
    and go to the tasks, however many tokens there are.  Order by class and token
    is one order of all tokens, so prefixes by it are exact."""
    ship(freq.sparkSession)
    weighty = freq.where("_w > 0 AND i IS NOT NULL")
    bits = min(max((4 * weighty.count()).bit_length(), SLOT_BITS[0]), SLOT_BITS[1])

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = _slots(b.column("i").to_numpy(), bits)
            weight = np.minimum(np.ceil(CLASSES * np.log2(b.column("_w").to_numpy() + 1.0)), 255)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)) for x in (slot >> 16, slot & 0xFFFF, weight)],
                                             ["part", "slot", "weight"])

    def packed(table: pa.Table) -> pa.Table:
        classes = np.zeros(1 << 16, np.uint8)
        np.maximum.at(classes, table["slot"].to_numpy(), table["weight"].to_numpy().astype(np.uint8))
        return pa.table({"part": table["part"].slice(0, 1), "classes": pa.array([classes.tobytes()], pa.binary())})

    parts = weighty.select("i", "_w").mapInArrow(classed, "part int, slot int, weight int")
    table = np.zeros(1 << bits, np.uint8)
    for r in parts.groupBy("part").applyInArrow(packed, "part int, classes binary").collect():
        table[r["part"] << 16:(r["part"] + 1) << 16] = np.frombuffer(r["classes"], np.uint8)
    return freq.sparkSession.sparkContext.broadcast(table)


def _spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of the spans ``start .. start + length``, one after another."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + length, length)


def _parts(tokens: np.ndarray, start: np.ndarray, length: np.ndarray, known: np.ndarray) -> pa.ListArray:
    """A span of ``tokens`` per row, null where it is not ``known``."""
    length = np.where(known, length, 0)
    offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens[_spans(start, length)]), mask=pa.array(~known))


def _prefixes(inter: DataFrame, classes: Broadcast, t: float) -> DataFrame:
    """Prefix rows ``(tok, u, n, pos, pre, items)`` of ``(u, i)`` rows, tokens of
    a set in the order of their weight class, then their own.  ``pre`` holds the
    tokens before ``pos`` where the prefix is no longer than :data:`EARLIER`, else
    null, ``items`` the whole set up to :data:`SMALL_SET` tokens, else null.
    Tokens that are in no other set give no row (but for a few that share the slot
    of one that is); they do count as positions."""
    earlier, small = EARLIER, SMALL_SET

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = classes.value
        bits = len(table).bit_length() - 1
        for b in batches:
            sizes = b.column("s").value_lengths().to_numpy().astype(np.int64)
            flat, ends = b.column("s").flatten().to_numpy().astype(np.int64), np.cumsum(sizes)
            at = 0
            while at < len(sizes):
                begin = ends[at] - sizes[at]
                to = max(int(np.searchsorted(ends, begin + SORTED, "right")), at + 1)
                n, tokens = sizes[at:to], flat[begin:ends[to - 1]]
                who, first = np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
                weight = table[_slots(tokens, bits)]
                order = np.lexsort((tokens, weight, who))
                tokens, weight = tokens[order], weight[order]
                length = (n - np.ceil(n * t) + 1).astype(np.int64)
                place = np.arange(len(tokens)) - first[who]
                k = np.flatnonzero((place < length[who]) & (weight > 0))
                who, place = who[k], place[k]
                if len(k):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tokens[k]), b.column("u").take(pa.array(who + at)), pa.array(n[who]),
                         pa.array((place + 1).astype(np.int32)), _parts(tokens, first[who], place, length[who] <= earlier),
                         _parts(tokens, first[who], n[who], n[who] <= small)], ["tok", "u", "n", "pos", "pre", "items"])
                at = to

    tokens = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("tok", T.LongType()), T.StructField("u", inter.schema["u"].dataType),
                           T.StructField("n", T.LongType()), T.StructField("pos", T.IntegerType()),
                           T.StructField("pre", tokens), T.StructField("items", tokens)])
    return inter.groupBy("u").agg(F.collect_list("i").alias("s")).select("u", "s").mapInArrow(cut, schema)


def _whole_sets(inter: DataFrame, big: DataFrame) -> DataFrame:
    """All tokens of big sets as prefix rows."""
    none = F.lit(None).cast("array<bigint>")
    return inter.join(big, "u").select(F.col("i").alias("tok"), "u", "n", F.lit(1).alias("pos"),
                                       none.alias("pre"), none.alias("items"))


def prefix_tokens(inter: DataFrame, threshold: float, big_set: int = BIG_SET,
                  big: tuple[DataFrame, int] | None = None) -> DataFrame:
    """Prefix of each set under the global rare-first order, as rows of :func:`_prefixes`.

    Two sets with Jaccard ``>= t`` share a token among their first
    ``n - ceil(t * n) + 1`` rarest tokens (prefix filtering); with
    ``t = 1 - threshold`` this keeps every pair with distance below the
    threshold.  Token frequencies are one grouped count; sets of at most
    ``big_set`` elements are gathered and sorted.  Bigger sets index all their
    tokens: a longer prefix is still exact (it only adds candidates) and needs
    no ranking; their ``pos`` is 1, which switches the positional filter off
    for them.  A token of a single set meets nothing and gives no row.
    """
    big, n_big = big if big is not None else _bounded_broadcast(big_entities(inter, big_set))
    small = inter.join(big.select("u"), "u", "left_anti") if n_big else inter
    freq = cut_lineage(inter.groupBy("i").agg((F.count(F.lit(1)) - 1).alias("_w")), "frequencies")
    out = _prefixes(small, _weight_classes(freq), least_similarity(threshold))
    return out.unionByName(_whole_sets(inter, big)) if n_big else out


def joint_prefixes(left: DataFrame, right: DataFrame, threshold: float, big_l: tuple[DataFrame, int],
                   big_r: tuple[DataFrame, int]) -> tuple[DataFrame, DataFrame]:
    """Prefix rows of two tables of sets under one token order.

    Tokens come in the order of the pairs they would form, (sets of the left)
    x (sets of the right): a token that only one table holds comes first, fills
    the prefixes and forms none.
    """
    held = (left.select("i", F.lit(1).alias("_l"), F.lit(0).alias("_r"))
            .unionByName(right.select("i", F.lit(0).alias("_l"), F.lit(1).alias("_r"))))
    freq = cut_lineage(held.groupBy("i").agg((F.sum("_l") * F.sum("_r")).alias("_w")), "joint-frequencies")
    t, classes = least_similarity(threshold), _weight_classes(freq)
    out = []
    for inter, (big, n_big) in ((left, big_l), (right, big_r)):
        small = inter.join(big.select("u"), "u", "left_anti") if n_big else inter
        rows = _prefixes(small, classes, t)
        out.append(rows.unionByName(_whole_sets(inter, big)) if n_big else rows)
    return out[0], out[1]


# ------------------------------------------------------------ verification

def _shared_bucket(ha: Column, hb: Column, num_tables: int) -> Column:
    return reduce(lambda x, y: x | y, [ha[t] == hb[t] for t in range(num_tables)])


def _scored(df: DataFrame, threshold: float | None) -> DataFrame:
    out = df.where(F.col("inter") > 0).withColumn(
        "sim", F.col("inter").cast("double") / (F.col("n_a") + F.col("n_b") - F.col("inter")).cast("double"))
    if threshold is not None:
        out = out.where(F.lit(1.0) - F.col("sim") < F.lit(threshold))
    return out


def _bit_maps(inter: DataFrame, model: MinHashModel) -> DataFrame:
    """``(u, n, hashes, bits)``: size, signature and a bit map of the elements' hashes."""
    h, tables = F.xxhash64("i"), range(model.num_tables)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.shiftright(h, 8), F.lit(64)).cast("int"))
    rows = inter.select("u", "i", F.pmod(h, F.lit(MAP_WORDS)).alias("_w"), bit.alias("_b"))
    aggs = [F.count(F.lit(1)).alias("n"), *[F.min(model.hash_col(F.col("i"), t)).alias(f"_h{t}") for t in tables]]
    aggs += [F.coalesce(F.bit_or(F.when(F.col("_w") == w, F.col("_b"))), F.lit(0).cast("bigint")).alias(f"_m{w}")
             for w in range(MAP_WORDS)]
    return rows.groupBy("u").agg(*aggs).select("u", "n", F.array(*[f"_h{t}" for t in tables]).alias("hashes"),
                                               F.array(*[f"_m{w}" for w in range(MAP_WORDS)]).alias("bits"))


def _plausible(pairs: DataFrame, inter: DataFrame, inter_b: DataFrame, threshold: float, model: MinHashModel) -> DataFrame:
    """The pairs that share a bucket and whose bit maps leave room for the overlap
    they need (elements whose bit the other set lacks are not in it), told before
    any set is fetched."""
    maps = cut_lineage(_bit_maps(inter, model), "bit-maps")
    maps_b = maps if inter_b is inter else cut_lineage(_bit_maps(inter_b, model), "bit-maps")
    row = 8 * (2 + model.num_tables + MAP_WORDS)

    def side(df: DataFrame, x: str) -> DataFrame:
        return df.select(F.col("u").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "hashes", "bits")])

    def apart(x: str, y: str) -> Column:
        return reduce(lambda p, q: p + q, [F.bit_count(F.col(f"bits_{x}")[w].bitwiseAND(F.bitwise_not(F.col(f"bits_{y}")[w])))
                                           for w in range(MAP_WORDS)])

    t = F.lit(least_similarity(threshold))
    most = F.least(F.col("n_a") - apart("a", "b"), F.col("n_b") - apart("b", "a"))

    def near(some: DataFrame) -> DataFrame:
        met = some.join(side(maps, "a"), "a").join(side(maps_b, "b"), "b")
        met = met.where(_shared_bucket(F.col("hashes_a"), F.col("hashes_b"), model.num_tables))
        return met.where(most >= t / (F.lit(1.0) + t) * (F.col("n_a") + F.col("n_b")) - F.lit(1e-6)).select("a", "b")

    return _in_slices(pairs, row, row * maps.count(), near, "near-pairs")


def _in_slices(pairs: DataFrame, each: float, budget: float, step: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """``step`` of written ``pairs``, each of which sends ``each`` bytes along: beyond
    ``budget`` slice by slice, so that no more than a slice lies on the disks.  Pairs
    of groups of near copies grow with the square of the sets, a slice does not."""
    slices = min(math.ceil(pairs.count() * each / max(budget, SLICE_BYTES)), MOST_SLICES)
    if slices <= 1:
        return step(pairs)
    mine = F.pmod(F.xxhash64("a"), F.lit(slices))
    return reduce(DataFrame.unionByName, [cut_lineage(step(pairs.where(mine == k)), name) for k in range(slices)])


def _fetched(inter: DataFrame, pairs: DataFrame, *ends: str) -> DataFrame:
    """The rows of the sets at the ``ends`` of pairs, where the ids may be sent to the rows; else all."""
    ids = pairs.select(F.explode(F.array(*ends)).alias("u")).distinct()
    return inter.join(F.broadcast(ids), "u", "left_semi") if ids.count() <= SENT_IDS else inter


def _verify_arrays(pairs: DataFrame, prof: DataFrame, prof_b: DataFrame | None,
                   num_tables: int | None) -> DataFrame:
    pa = prof.select(F.col("u").alias("a"), F.col("n").alias("n_a"), F.col("items").alias("items_a"),
                     *([F.col("hashes").alias("hashes_a")] if num_tables else []))
    pb = (prof if prof_b is None else prof_b).select(
        F.col("u").alias("b"), F.col("n").alias("n_b"), F.col("items").alias("items_b"),
        *([F.col("hashes").alias("hashes_b")] if num_tables else []))
    joined = pairs.select("a", "b").join(pa, "a").join(pb, "b")
    inter = F.size(F.array_intersect("items_a", "items_b")).cast("bigint")
    if num_tables:
        # the 5-long signature test gates the array work: the threshold test
        # is pushed into the join condition with ``inter`` substituted, so a
        # pair without a shared bucket must not reach array_intersect at all
        inter = F.when(_shared_bucket(F.col("hashes_a"), F.col("hashes_b"), num_tables), inter) \
                 .otherwise(F.lit(0).cast("bigint"))
    # exploding the one count keeps filters on it out of the join condition,
    # where it would be computed a second time
    return joined.select("a", "b", F.explode(F.array(inter)).alias("inter"),
                         F.col("n_a").cast("bigint").alias("n_a"), F.col("n_b").cast("bigint").alias("n_b"))


def _verify_long(pairs: DataFrame, inter_a: DataFrame, inter_b: DataFrame,
                 sig_a: DataFrame, sig_b: DataFrame, num_tables: int | None) -> DataFrame:
    """Intersections without gathering sets: expand each pair by the
    elements of its smaller side, keep those the other side holds, count.
    Work per pair is ``min(n_a, n_b)`` rows; no row ever holds a whole set."""
    sa = sig_a.select(F.col("u").alias("a"), F.col("n").alias("n_a"),
                      *([F.col("hashes").alias("hashes_a")] if num_tables else []))
    sb = sig_b.select(F.col("u").alias("b"), F.col("n").alias("n_b"),
                      *([F.col("hashes").alias("hashes_b")] if num_tables else []))
    p = pairs.select("a", "b").join(sa, "a").join(sb, "b")
    if num_tables:
        p = p.where(_shared_bucket(F.col("hashes_a"), F.col("hashes_b"), num_tables))
    p = p.select("a", "b", "n_a", "n_b", (F.col("n_a") <= F.col("n_b")).alias("_left"))
    from_a = (p.where("_left").join(inter_a.select(F.col("u").alias("a"), "i"), "a")
               .join(inter_b.select(F.col("u").alias("b"), "i"), ["b", "i"], "left_semi"))
    from_b = (p.where(~F.col("_left")).join(inter_b.select(F.col("u").alias("b"), "i"), "b")
               .join(inter_a.select(F.col("u").alias("a"), "i"), ["a", "i"], "left_semi"))
    hits = from_a.unionByName(from_b)
    return (hits.groupBy("a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).cast("bigint").alias("inter"))
                .select("a", "b", "inter", F.col("n_a").cast("bigint").alias("n_a"),
                        F.col("n_b").cast("bigint").alias("n_b")))


def verify(pairs: DataFrame, inter: DataFrame, threshold: float | None = None,
           model: MinHashModel | None = None, inter_b: DataFrame | None = None,
           check_buckets: bool = False, big_set: int = BIG_SET,
           big: tuple[DataFrame, int] | None = None) -> DataFrame:
    """``(a, b, inter, n_a, n_b, sim)`` for candidate pairs over long-form sets.

    ``sim = inter / (n_a + n_b - inter)``; a threshold keeps
    ``1 - sim < threshold`` (strict, as Spark ML's distance test).  With
    ``check_buckets`` the pair must also agree on at least one signature
    entry of ``model``.  Sets up to ``big_set`` elements are gathered into
    sorted arrays (one row per entity) and intersected per pair; pairs with a
    bigger set are counted in long form instead.
    """
    two = inter_b is not None
    inter_b = inter if inter_b is None else inter_b
    # written pairs and profiles: joins on ``a`` and ``b`` are then plain
    # shuffles, and Spark can split an entity that is in very many pairs
    pairs = cut_lineage(pairs.select("a", "b"), "pairs")
    if check_buckets and threshold is not None:
        pairs = cut_lineage(_plausible(pairs, inter, inter_b, threshold, model), "plausible-pairs")
        if inter_b is inter:
            inter = inter_b = _fetched(inter, pairs, "a", "b")
        else:
            inter, inter_b = _fetched(inter, pairs, "a"), _fetched(inter_b, pairs, "b")
    tables = model.num_tables if check_buckets else None
    big_a, n_big_a = big if big is not None else _bounded_broadcast(big_entities(inter, big_set))
    big_b, n_big_b = (big_a, n_big_a) if inter_b is inter else _bounded_broadcast(big_entities(inter_b, big_set))
    small_a = inter.join(big_a.select("u"), "u", "left_anti") if n_big_a else inter
    small_b = inter_b.join(big_b.select("u"), "u", "left_anti") if n_big_b else inter_b
    prof_a = cut_lineage(profiles(small_a, model if check_buckets else None), "profiles")
    prof_b = cut_lineage(profiles(small_b, model if check_buckets else None), "profiles") if two else prof_a
    one = None if inter_b is inter else prof_b
    if check_buckets and threshold is not None:
        size = prof_a.agg(F.sum("n").alias("all"), F.avg("n").alias("mean")).first()
        out = _in_slices(pairs, 8 * (size["mean"] or 0) + 100, 8 * (size["all"] or 0),
                         lambda some: _verify_arrays(some, prof_a, one, tables), "verified")
    else:
        out = _verify_arrays(pairs, prof_a, one, tables)
    if n_big_a or n_big_b:
        is_big = F.lit(False)
        p = pairs.select("a", "b")
        if n_big_a:
            p = p.join(big_a.select(F.col("u").alias("a"), F.lit(True).alias("_ba")), "a", "left")
            is_big = is_big | F.col("_ba").isNotNull()
        if n_big_b:
            p = p.join(big_b.select(F.col("u").alias("b"), F.lit(True).alias("_bb")), "b", "left")
            is_big = is_big | F.col("_bb").isNotNull()
        big_pairs = p.where(is_big).select("a", "b")
        sig_a = signatures(inter, model) if check_buckets else inter.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        sig_b = sig_a if inter_b is inter else (
            signatures(inter_b, model) if check_buckets else inter_b.groupBy("u").agg(F.count(F.lit(1)).alias("n")))
        out = out.unionByName(_verify_long(big_pairs, inter, inter_b, sig_a, sig_b, tables))
    return _scored(out, threshold)


def _prefix_pairs_lower_bound(inter: DataFrame, bkt: DataFrame, threshold: float) -> float:
    """Lower bound on the pairs the prefix route would form, from set sizes.

    With ``S`` prefix rows spread over at most ``V`` distinct tokens,
    ``sum(m^2) >= S^2 / V`` (Cauchy-Schwarz), so the route forms at least
    ``S^2 / (2V) - S / 2`` pairs.  Needs no per-set ranking: ``S`` comes
    from the sizes already on the bucket rows, ``V`` from one distinct count.
    """
    t = max(0.0, 1.0 - threshold - _EPS)
    n = F.col("n")
    s_rows = (bkt.where(F.col("tb") == 0)
                 .agg(F.sum(n - F.ceil(n * F.lit(t)) + 1).alias("s")).first()["s"] or 0)
    v = inter.agg(F.countDistinct("i").alias("v")).first()["v"] or 0
    if v == 0:
        return 0.0
    return s_rows * s_rows / (2.0 * v) - s_rows / 2.0


def choose_plan(inter: DataFrame, model: MinHashModel, threshold: float | None,
                block_size: int = DEFAULT_BLOCK, big_set: int = BIG_SET,
                big: tuple[DataFrame, int] | None = None) -> dict:
    """Pick the candidate route from exact group-size statistics.

    ``buckets``: groups are (table, hash); ``prefix``: groups are prefix
    tokens.  Work is estimated as the pairs each would form; the smaller wins
    (only buckets without a threshold).  The prefix count needs every set
    ranked, so a size-only lower bound is tried first and the ranking is
    skipped when buckets already win against it.  Either way pairs are deduplicated on
    the two ids before the sets are fetched, so each pair is verified once
    (carrying the sets through the group join measured 2-3x slower: a pair
    meeting in several groups is intersected several times and the join
    copies arrays into every emitted row).
    """
    plan = {"strategy": "buckets"}
    if threshold is not None and threshold <= PREFIX_ALWAYS:
        # J >= 1 - threshold >= 0.5: prefixes are at most half of each set and
        # skip the common tokens, while single-hash buckets still pair up a
        # fixed share of all dissimilar sets; no need to measure.
        pre = cut_lineage(prefix_tokens(inter, threshold, big_set, big))
        plan.update(strategy="prefix", prefix_rows=pre)
        plan["prefix_pairs"], plan["prefix_hot"] = group_stats(pre, ["tok"], block_size)
        return plan
    bkt = cut_lineage(buckets(signatures(inter, model), with_hashes=True))
    plan["bucket_rows"] = bkt
    plan["bucket_pairs"], plan["bucket_hot"] = group_stats(bkt, ["tb", "hv"], block_size)
    if threshold is not None and threshold < 1.0:
        plan["prefix_lower"] = _prefix_pairs_lower_bound(inter, bkt, threshold)
        if plan["prefix_lower"] >= plan["bucket_pairs"]:
            return plan                     # buckets win without ranking any set
        pre = cut_lineage(prefix_tokens(inter, threshold, big_set, big))
        plan["prefix_rows"] = pre
        plan["prefix_pairs"], plan["prefix_hot"] = group_stats(pre, ["tok"], block_size)
        if plan["prefix_pairs"] < plan["bucket_pairs"]:
            plan["strategy"] = "prefix"
    return plan


def _block_pairs(left: DataFrame, right: DataFrame | None, threshold: float | None, model: MinHashModel | None,
                 block_size: int) -> DataFrame | None:
    """The verified pairs of sets over few distinct elements, block by block;
    None where the groups' pairs cost less.  Without a model: all pairs, no
    signatures, and the work of the prefixes is told from the set sizes."""
    sides = [left] if right is None else [left, right]
    items = dense.elements(*sides)
    if not items:
        return None
    sets = [dense.bit_sets(s, items, model) for s in sides]
    n = [s.count() for s in sets]
    all_pairs = n[0] * (n[0] - 1) / 2 if right is None else n[0] * n[1]
    if not dense.cheaper(all_pairs, all_pairs * len(items), len(items)):
        return None
    least = 0.0 if threshold is None else least_similarity(threshold)
    # a prefix row meets on average the share of rows that the most even spread over all elements gives
    rows = [s.agg(F.sum(prefix_length(F.col("n"), F.lit(least)))).first()[0] or 0 for s in sets]
    work = (rows[0] * (rows[0] - 1) / 2 if right is None else rows[0] * rows[1]) / len(items)
    if model is not None and (threshold is None or threshold > PREFIX_ALWAYS):
        met = [buckets(s) for s in sets]
        met = group_stats(met[0], ["tb", "hv"], block_size)[0] if right is None else across_stats(*met, ["tb", "hv"], block_size)["pairs"]
        work = met if threshold is None or threshold >= 1.0 else min(met, work)
    if not dense.cheaper(all_pairs, work, len(items)):
        return None
    found = dense.pairs(sets[0], n[0], None if right is None else sets[1], n[-1], len(items), least, model is not None)
    found = _scored(found, threshold)
    return found if right is not None else dense.noted(
        found, dense.Met(sets[0], n[0], len(items), least, model is not None, threshold))


def _copies(inter: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``(heads, members)``: the rows of one entity of each group of equal sets,
    and ``(rep, u)`` of the groups of several entities (None: there is none)."""
    h = F.xxhash64("i")
    mark = inter.where("u IS NOT NULL").groupBy("u").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.bit_xor(F.xxhash64("i", F.lit(1))).alias("y"),
        F.sum(F.pmod(h, F.lit(1 << 31))).alias("z"))             # the sum tells repeated rows apart
    mark, keys = cut_lineage(mark, "set-marks"), ["n", "x", "y", "z"]
    first = mark.groupBy(*keys).agg(F.min("u").alias("rep"), F.count(F.lit(1)).alias("_m")).where("_m > 1")
    members = cut_lineage(mark.join(first, keys).select("rep", "u", "n"), "equal-sets")
    more = members.where("u != rep").select("u")
    count = more.count()
    if not count:
        return inter, None
    return inter.join(F.broadcast(more) if count <= BROADCAST_ROWS else more, "u", "left_anti"), members


def _with_copies(found: DataFrame, copies_a: DataFrame | None, copies_b: DataFrame | None) -> DataFrame:
    """Verified pairs of heads with a row for each two members of their groups."""
    for side, copies in (("a", copies_a), ("b", copies_b)):
        if copies is not None:
            each = copies.select(F.col("rep").alias(side), F.col("u").alias("_u"))
            found = found.join(each, side, "left").withColumn(side, F.coalesce("_u", side)).drop("_u")
    return found.select("a", "b", "inter", "n_a", "n_b", "sim")


def _within_copies(own: DataFrame, members: DataFrame, block_size: int) -> DataFrame:
    """The pairs inside groups of equal sets, valued as the pair of a head with itself in ``own``."""
    rows = members.join(own.select(F.col("a").alias("rep")), "rep", "left_semi")
    inside = _group_join(rows, ["rep"], None, block_size, ["rep"], out_cols=["rep"])
    values = own.select(F.col("a").alias("rep_a"), "inter", "n_a", "n_b", "sim")
    return inside.join(values, "rep_a").select("a", "b", "inter", "n_a", "n_b", "sim")


def _ordered(found: DataFrame) -> DataFrame:
    """Pairs with ``a < b`` and the sizes to them."""
    lo = F.col("a") < F.col("b")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "inter",
                        F.when(lo, F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
                        F.when(lo, F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"), "sim")


def _prefix_join(inter: DataFrame, model: MinHashModel, threshold: float, block_size: int, big_set: int) -> DataFrame:
    """The self-join by prefixes.  Equal sets are joined once, as their smallest
    entity; only pairs of ids are made for their other members."""
    heads, members = _copies(inter)
    big, _, largest = entity_stats(heads, big_set)
    rows = cut_lineage(prefix_tokens(heads, threshold, big_set, big), "prefixes")
    pairs = pairs_in_groups(rows, ["tok"], threshold, block_size, all_once=meets_once(threshold, largest, big[1]))
    if members is not None:
        pairs = pairs.unionByName(members.where("u = rep").select(F.col("u").alias("a"), F.col("u").alias("b")))
    found = verify(pairs, heads, threshold, model, check_buckets=True, big_set=big_set, big=big)
    if members is None:
        return found
    found = cut_lineage(found, "head-pairs")
    between = _ordered(_with_copies(found.where("a != b"), members, members))
    return between.unionByName(_within_copies(found.where("a = b"), members, block_size))


def similarity_join(inter: DataFrame, model: MinHashModel, threshold: float | None = None,
                    strategy: str = "auto", block_size: int = DEFAULT_BLOCK,
                    materialize: bool = True, big_set: int = BIG_SET) -> DataFrame:
    """Approximate similarity self-join (D5): pairs sharing a bucket in any
    table, verified, distance strictly below ``threshold`` (all candidate
    pairs when ``threshold`` is None).  Output ``(a, b, inter, n_a, n_b, sim)``.

    ``strategy``: ``'buckets'`` joins on (table, hash); ``'prefix'`` finds
    the exact pairs by prefix filtering and keeps those whose signatures agree
    somewhere — the same pair set.  ``'auto'`` picks by :func:`choose_plan`, or
    takes blocks where the sets draw on few elements.
    """
    if materialize:
        inter = cut_lineage(inter)
    by_blocks = _block_pairs(inter, None, threshold, model, block_size) if strategy == "auto" else None
    if by_blocks is not None:
        return by_blocks
    if threshold is not None and (strategy == "prefix" or strategy == "auto" and threshold <= PREFIX_ALWAYS):
        return _prefix_join(inter, model, threshold, block_size, big_set)
    big, smallest, largest = entity_stats(inter, big_set)      # once per join
    if strategy == "auto":
        plan = choose_plan(inter, model, threshold, block_size, big_set, big)
    else:
        plan = {"strategy": strategy}
    if plan["strategy"] == "prefix" and threshold is None:
        raise ValueError("prefix strategy needs a threshold")
    if plan["strategy"] == "prefix":
        rows = plan.get("prefix_rows")
        rows = prefix_tokens(inter, threshold, big_set, big) if rows is None else rows
        keys, check = ["tok"], True
        stats = (plan["prefix_pairs"], plan["prefix_hot"]) if "prefix_hot" in plan else None
    elif plan["strategy"] == "buckets":
        rows = plan.get("bucket_rows")
        rows = buckets(signatures(inter, model), with_hashes=True) if rows is None else rows
        keys, check = ["tb", "hv"], False
        stats = (plan["bucket_pairs"], plan["bucket_hot"]) if "bucket_hot" in plan else None
    else:
        raise ValueError(f"unknown strategy {plan['strategy']!r}")
    if threshold is not None and not check:
        rows = _with_short_sets(rows, inter, smallest)
    once = check and meets_once(threshold, largest, big[1])
    pairs = pairs_in_groups(rows, keys, threshold, block_size, stats, model.num_tables, once)
    return verify(pairs, inter, threshold, model, check_buckets=check, big_set=big_set, big=big)


def similarity_join_two(left: DataFrame, right: DataFrame, model: MinHashModel,
                        threshold: float | None, block_size: int = DEFAULT_BLOCK,
                        big_set: int = BIG_SET, strategy: str = "auto") -> DataFrame:
    """Similarity join between two tables of sets (D5, A x B): ``a`` from
    ``left``, ``b`` from ``right``, both long form ``(u, i)``.

    ``strategy`` as in :func:`similarity_join`: ``'buckets'`` joins on (table,
    hash), ``'prefix'`` on prefix tokens under a joint order and keeps pairs
    whose signatures agree somewhere; ``'auto'`` counts the pairs that each
    would form and takes the smaller number (thresholds up to
    :data:`PREFIX_ALWAYS` always take prefixes, and up to :data:`PLAN_PAIRS`
    bucket pairs prefixes are not counted), or blocks where the sets draw on few
    elements.
    """
    if strategy not in ("auto", "buckets", "prefix"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "prefix" and threshold is None:
        raise ValueError("prefix strategy needs a threshold")
    left, right = cut_lineage(left, "left"), cut_lineage(right, "right")
    by_blocks = _block_pairs(left, right, threshold, model, block_size) if strategy == "auto" else None
    if by_blocks is not None:
        return by_blocks
    prefix = threshold is not None and threshold < 1.0 and strategy != "buckets"
    found, stats, once = {}, {}, False
    if strategy != "prefix" and not (prefix and threshold <= PREFIX_ALWAYS):
        found["buckets"] = [cut_lineage(buckets(signatures(x, model), with_hashes=True), f"{name}-buckets")
                            for name, x in (("left", left), ("right", right))]
        stats["buckets"] = across_stats(*found["buckets"], ["tb", "hv"], block_size)
    few = "buckets" in stats and stats["buckets"]["pairs"] <= PLAN_PAIRS       # not worth a second count
    if strategy == "prefix" or prefix and not few:
        (heads_l, copies_l), (heads_r, copies_r) = _copies(left), _copies(right)
        big_l, _, most_l = entity_stats(heads_l, big_set)
        big_r, _, most_r = entity_stats(heads_r, big_set)
        found["prefix"] = [cut_lineage(x, "prefixes") for x in joint_prefixes(heads_l, heads_r, threshold, big_l, big_r)]
        once = meets_once(threshold, most_l, big_l[1]) and meets_once(threshold, most_r, big_r[1])
        stats["prefix"] = across_stats(*found["prefix"], ["tok"], block_size)
    route = min(stats, key=lambda x: stats[x]["pairs"])
    keys = ["tb", "hv"] if route == "buckets" else ["tok"]
    pairs = pairs_across_groups(*found[route], keys, threshold, block_size,
                                model.num_tables if route == "buckets" else 0, stats[route], once)
    if route == "buckets":
        return verify(pairs, left, threshold, model, inter_b=right, big_set=big_set)
    # equal sets of a table are joined once; their other members get pairs of ids
    met = verify(pairs, heads_l, threshold, model, inter_b=heads_r, check_buckets=True, big_set=big_set)
    if copies_l is None and copies_r is None:
        return met
    return _with_copies(cut_lineage(met, "head-pairs"), copies_l, copies_r)


def exact_jaccard(inter: DataFrame, threshold: float, block_size: int = DEFAULT_BLOCK,
                  materialize: bool = True, big_set: int = BIG_SET) -> DataFrame:
    """All pairs with Jaccard distance strictly below ``threshold`` (D8), no
    hashing: prefix-filtered candidates, then exact verification, or blocks
    where the sets draw on few elements."""
    if materialize:
        inter = cut_lineage(inter)
    by_blocks = _block_pairs(inter, None, threshold, None, block_size)
    if by_blocks is not None:
        return by_blocks
    big, _, largest = entity_stats(inter, big_set)
    pre = cut_lineage(prefix_tokens(inter, threshold, big_set, big), "prefixes")
    pairs = pairs_in_groups(pre, ["tok"], threshold, block_size, all_once=meets_once(threshold, largest, big[1]))
    return verify(pairs, inter, threshold, big_set=big_set, big=big)


# ------------------------------------------------------ nearest neighbours

def neighbors(inter: DataFrame, model: MinHashModel, key: int, k: int) -> DataFrame:
    """Approximate ``k`` nearest neighbours of one entity (D6).

    Like Spark ML's single-probe search: entities sharing a bucket with the
    key, ranked by Jaccard distance (ties by id), the key itself included at
    distance 0; fewer than ``k`` rows when fewer candidates exist.
    """
    sig = cut_lineage(signatures(inter, model), "signatures")
    probe = sig.where(F.col("u") == F.lit(key)).select("n", "hashes").take(1)   # the key's own row
    if not probe:
        return (sig.limit(0).select(F.col("u"), F.col("u").alias("v"), F.lit(0.0).alias("sim"),
                                    F.lit(0).cast("bigint").alias("rank")))
    key_n, key_hashes = int(probe[0]["n"]), probe[0]["hashes"]
    shares = reduce(lambda x, y: x | y, [F.col("hashes")[t] == F.lit(h) for t, h in enumerate(key_hashes)])
    cand = sig.where(shares).select("u", "n")                 # a filter: no bucket join
    items = inter.where(F.col("u") == F.lit(key)).select("i")
    items = F.broadcast(items) if key_n <= BROADCAST_ROWS else items
    overlap = inter.join(items, "i").groupBy("u").agg(F.count(F.lit(1)).alias("inter"))
    res = (cand.join(overlap, "u")
               .select(F.lit(key).cast("bigint").alias("u"), F.col("u").alias("v"),
                       (F.col("inter") / (F.col("n") + F.lit(key_n) - F.col("inter"))).alias("sim")))
    top = res.orderBy(F.desc("sim"), "v").limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("sim"), "v")).cast("bigint"))


def symmetric(pairs: DataFrame) -> DataFrame:
    """``(u, v, sim)`` in both directions from ``(a, b, sim)`` pairs."""
    both = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                   F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    # one pass over the pairs (a union would plan the whole pair job twice)
    return pairs.select(F.explode(both).alias("_d"), "sim").select("_d.u", "_d.v", "sim")


def top_k_per(df: DataFrame, part: str, order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """``row_number() <= k`` per ``part``; Catalyst adds a partial window
    group limit before the shuffle, so each map task ships at most ``k`` rows
    per key."""
    w = Window.partitionBy(part).orderBy(*order)
    return (df.withColumn(rank, F.row_number().over(w))
              .where(F.col(rank) <= k)
              .withColumn(rank, F.col(rank).cast("bigint")))


def all_neighbors(pairs: DataFrame, k: int) -> DataFrame:
    """Top ``k`` neighbours of every entity from verified pairs (D7)."""
    return top_k_per(symmetric(pairs), "u", [F.desc("sim"), F.col("v")], k)


def equal_sets(inter: DataFrame) -> DataFrame:
    """``(u, rep)``: the smallest entity with the same set, told by set size and
    128 bits of an order-free fingerprint."""
    mark = inter.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("i")).alias("x"),
                                  F.bit_xor(F.xxhash64("i", F.lit(1))).alias("y"))
    mark = cut_lineage(mark, "set-marks")
    first = cut_lineage(mark.groupBy("n", "x", "y").agg(F.min("u").alias("rep")), "set-groups")
    return mark.join(first, ["n", "x", "y"]).select("u", "rep")


def grouped_neighbors(inter: DataFrame, model: MinHashModel, threshold: float, k: int) -> DataFrame:
    """Top ``k`` neighbours of every entity (D7) where many entities have equal
    sets: distinct sets are joined once, and a group passes on no more than its
    ``k + 1`` smallest members, so the output is linear in the entities."""
    inter = cut_lineage(inter, "sets")
    members = cut_lineage(equal_sets(inter), "members")
    heads = members.where("u = rep").select("u")
    pairs = similarity_join(inter.join(heads, "u", "left_semi"), model, threshold)
    own = heads.select(F.col("u").alias("u"), F.col("u").alias("v"), F.lit(1.0).alias("sim"))
    near = symmetric(pairs).unionByName(own).withColumnRenamed("v", "rep")
    shown = cut_lineage(top_k_per(members, "rep", [F.col("u")], k + 1).select("rep", F.col("u").alias("v")), "shown")
    best = top_k_per(near.join(shown, "rep"), "u", [F.desc("sim"), F.col("v")], k + 1)
    best = cut_lineage(best.select(F.col("u").alias("rep"), "v", "sim"), "group-neighbours")
    each = members.join(best, "rep").where("u != v").select("u", "v", "sim")
    return top_k_per(each, "u", [F.desc("sim"), F.col("v")], k)


# ------------------------------------------------------------------ report

def _common_counts(exact: DataFrame, approx: DataFrame) -> DataFrame:
    """``(exact_pairs, found_pairs, true_pairs)``; the rows are to be summed.  Pairs
    that both come block by block are counted where they meet."""
    met = dense.met_of(exact), dense.met_of(approx)
    if None not in met:
        return dense.common_counts(*met)
    e = exact.select("a", "b").withColumn("_e", F.lit(1))
    a = approx.select("a", "b").withColumn("_x", F.lit(1))
    return e.join(a, ["a", "b"], "full_outer").agg(
        F.count("_e").alias("exact_pairs"), F.count("_x").alias("found_pairs"),
        F.count(F.when(F.col("_e").isNotNull() & F.col("_x").isNotNull(), 1)).alias("true_pairs"))


def lsh_report(approx: DataFrame, exact: DataFrame, cands: DataFrame, n_entities: DataFrame) -> DataFrame:
    """One row: exact / found / true pairs, recall, precision, candidate ratio (D9).

    ``n_entities`` is a one-row DataFrame with column ``n``.
    """
    met = dense.met_of(cands)
    counted = _common_counts(exact, approx)
    counted = counted.unionByName(cands.agg(F.count(F.lit(1)).alias("candidate_pairs")) if met is None else
                                  dense.sharing_count(met).select(F.col("n").alias("candidate_pairs")), True)
    counted = counted.unionByName(n_entities.select(F.col("n").cast("bigint").alias("n")), True)
    sums = [F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c)
            for c in ("exact_pairs", "found_pairs", "true_pairs", "candidate_pairs")]
    row = counted.agg(*sums, (F.max("n") * (F.max("n") - 1) / 2).cast("bigint").alias("all_pairs"))
    return row.select(
        "exact_pairs", "found_pairs", "true_pairs",
        F.round(F.when(F.col("exact_pairs") > 0, F.col("true_pairs") / F.col("exact_pairs")), 6).alias("recall"),
        F.round(F.when(F.col("found_pairs") > 0, F.col("true_pairs") / F.col("found_pairs")), 6).alias("precision"),
        "candidate_pairs", "all_pairs",
        F.round(F.col("candidate_pairs") / F.col("all_pairs"), 6).alias("candidate_ratio"))
