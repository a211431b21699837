"""A bucket index that outlives one query (D6): sets, their buckets and the
model in one folder, written once and probed by any later session.

``buckets`` holds a row per set and hash table, in folders by table and range of
the hash value, so a probe opens one folder per table; ``sets`` holds a row per
set, in folders by a hash of the id, so the probed set itself is one folder too.
Sets of up to :data:`RIDE` elements ride along on their bucket rows and are
compared there; longer ones are in ``elements``, one row per element, in folders
like those of ``sets``.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lshark.functions.minhash import HASH_PRIME, MinHashModel
from lshark.operators import lsh
from lshark.session import cut_lineage
from lshark.sources import tables

RIDE = 1024                    # elements of a set that rides along on its bucket rows
RANGES = 32                    # folders per hash table
PARTS = 32                     # folders of sets and elements
# declared schemas: a table without rows has no files to tell its own
SCHEMAS = {
    "buckets": "u bigint, n bigint, items array<bigint>, hv bigint, tb int, hr int",
    "sets": "u bigint, n bigint, hashes array<bigint>, items array<bigint>, part int",
    "elements": "u bigint, i bigint, part int",
}
SALT = 8                       # writers of one folder, so that a hot bucket is not one task


def _range(hv: Column, ranges: int) -> Column:
    return F.floor(hv * F.lit(ranges) / F.lit(HASH_PRIME)).cast("int")


def _part(u: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(u), F.lit(parts)).cast("int")


def _write(df: DataFrame, path: str, by: list[str]) -> None:
    df.repartition(*by, F.pmod(F.xxhash64("u", F.lit(7)), F.lit(SALT))).write.partitionBy(*by).mode("overwrite").parquet(path)


@dataclass(frozen=True)
class BucketIndex:
    """An opened index: where it is, its model and its numbers of folders."""

    path: str
    model: MinHashModel
    ranges: int
    parts: int

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.schema(SCHEMAS[name]).parquet(os.path.join(self.path, name))


def write_index(inter: DataFrame, model: MinHashModel, path: str, ranges: int = RANGES, parts: int = PARTS) -> BucketIndex:
    """Index all sets of distinct ``(u, i)`` under ``path``."""
    spark = inter.sparkSession
    sig = cut_lineage(lsh.signatures(inter, model), "signatures")
    short = inter.join(sig.where(F.col("n") <= RIDE).select("u"), "u", "left_semi")
    items = short.groupBy("u").agg(F.array_sort(F.collect_list("i")).alias("items"))
    sets = cut_lineage(sig.join(items, "u", "left"), "indexed-sets")
    rows = sets.select("u", "n", "items", F.posexplode("hashes").alias("tb", "hv"))
    _write(rows.withColumn("hr", _range(F.col("hv"), ranges)), os.path.join(path, "buckets"), ["tb", "hr"])
    _write(sets.withColumn("part", _part(F.col("u"), parts)), os.path.join(path, "sets"), ["part"])
    long = inter.join(sig.where(F.col("n") > RIDE).select("u"), "u", "left_semi")
    _write(long.withColumn("part", _part(F.col("u"), parts)), os.path.join(path, "elements"), ["part"])
    tables.save_model(spark, model, os.path.join(path, "model"))
    spark.createDataFrame([(ranges, parts)], "ranges int, parts int").coalesce(1).write.mode("overwrite").parquet(
        os.path.join(path, "layout"))
    return BucketIndex(path, model, ranges, parts)


def open_index(spark: SparkSession, path: str) -> BucketIndex:
    layout = spark.read.parquet(os.path.join(path, "layout")).first()
    return BucketIndex(path, tables.load_model(spark, os.path.join(path, "model")), layout["ranges"], layout["parts"])


def bucket_rows(spark: SparkSession, index: BucketIndex, hashes: list[int]) -> DataFrame:
    """The rows of the buckets that a signature falls into: one folder per table is read."""
    at = [(t, h, h * index.ranges // HASH_PRIME) for t, h in enumerate(hashes)]
    folder = reduce(lambda x, y: x | y, [(F.col("tb") == t) & (F.col("hr") == r) for t, _, r in at])
    bucket = reduce(lambda x, y: x | y, [(F.col("tb") == t) & (F.col("hv") == h) for t, h, _ in at])
    return index.table(spark, "buckets").where(folder).where(bucket)


def probe(spark: SparkSession, index: BucketIndex, items: list[int] | DataFrame, size: int, hashes: list[int],
          k: int) -> DataFrame:
    """``(v, sim, rank)``: the ``k`` nearest sets of the index that share a
    bucket with a set of ``size`` ``items`` (a list, or a DataFrame of ``i``)."""
    met = bucket_rows(spark, index, hashes).groupBy("u").agg(F.first("n").alias("n"), F.first("items").alias("items"))
    mine = items if isinstance(items, DataFrame) else spark.createDataFrame([(int(i),) for i in items], "i bigint")
    if size <= RIDE:
        held = F.array(*[F.lit(int(r)).cast("bigint") for r in
                         (items if not isinstance(items, DataFrame) else sorted(x["i"] for x in mine.collect()))])
        near = met.where("items IS NOT NULL").select(
            "u", "n", F.size(F.array_intersect("items", held)).cast("bigint").alias("inter"))
    else:
        near = (met.where("items IS NOT NULL").select("u", "n", F.explode("items").alias("i")).join(mine, "i")
                .groupBy("u", "n").agg(F.count(F.lit(1)).alias("inter")))
    far = (met.where("items IS NULL").select("u", "n", _part(F.col("u"), index.parts).alias("part"))
           .join(index.table(spark, "elements"), ["part", "u"]).join(mine, "i")
           .groupBy("u", "n").agg(F.count(F.lit(1)).alias("inter")))
    both = near.unionByName(far).where("inter > 0")
    sim = F.col("inter") / (F.col("n") + F.lit(size) - F.col("inter"))
    top = both.select(F.col("u").alias("v"), sim.alias("sim")).orderBy(F.desc("sim"), "v").limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("sim"), "v")).cast("bigint"))


def neighbors(spark: SparkSession, index: BucketIndex, key: int, k: int) -> DataFrame:
    """``(u, v, sim, rank)``: the ``k`` nearest neighbours of one indexed set,
    itself included, as :func:`lshark.operators.lsh.neighbors` without reading
    the interactions.  An unknown key has none."""
    part = spark.range(1).select(_part(F.lit(key).cast("bigint"), index.parts)).first()[0]
    row = index.table(spark, "sets").where((F.col("part") == part) & (F.col("u") == key)).first()
    if row is None:
        return spark.createDataFrame([], "u bigint, v bigint, sim double, rank bigint")
    items = row["items"] if row["items"] is not None else (
        index.table(spark, "elements").where((F.col("part") == part) & (F.col("u") == key)).select("i"))
    found = probe(spark, index, items, row["n"], list(row["hashes"]), k)
    return found.select(F.lit(key).cast("bigint").alias("u"), "v", "sim", "rank")


def neighbors_of(spark: SparkSession, index: BucketIndex, items, k: int) -> DataFrame:
    """``(v, sim, rank)``: the ``k`` nearest indexed sets of a new set of elements."""
    items = sorted({int(i) for i in items})
    if not items:
        raise ValueError("an empty set has no signature")
    return probe(spark, index, items, len(items), index.model.signature(items), k)
