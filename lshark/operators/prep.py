"""Preprocessing: distinct interactions (B1), entity sets (B2), subset (A2)."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lshark.operators.features import dense_index, lookup
from lshark.session import cut_lineage

MOST_ITEMS = 50_000            # elements of a set gathered into one row


def interactions(df: DataFrame, user: str | Column, item: str | Column,
                 where: Column | None = None) -> DataFrame:
    """Distinct ``(u, i)`` pairs with both keys non-null (B1).

    ``distinct`` is a hash aggregate with a map-side partial step, so a user
    holding a large share of the rows is deduplicated before the shuffle.
    """
    u = F.col(user) if isinstance(user, str) else user
    i = F.col(item) if isinstance(item, str) else item
    if where is not None:
        df = df.where(where)
    return (df.select(u.cast("bigint").alias("u"), i.cast("bigint").alias("i"))
              .where(F.col("u").isNotNull() & F.col("i").isNotNull())
              .distinct())


def keyed_interactions(df: DataFrame, user: str | Column, item: str | Column,
                       where: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(inter, users, items)`` for keys of any type (B1): distinct ``(u, i)``
    of their dense numbers and the two written dictionaries ``(value, idx)``.
    Numbers follow the keys' order, so ties by number are ties by key;
    :func:`named` brings the keys back."""
    df = df if where is None else df.where(where)
    u = F.col(user) if isinstance(user, str) else user
    i = F.col(item) if isinstance(item, str) else item
    rows = cut_lineage(df.select(u.alias("_u"), i.alias("_i")).where("_u IS NOT NULL AND _i IS NOT NULL").distinct(), "keys")
    users = cut_lineage(dense_index(rows, "_u"), "user-keys")
    items = cut_lineage(dense_index(rows, "_i"), "item-keys")
    inter = lookup(lookup(rows, users, "_u", "u"), items, "_i", "i")
    return inter.select("u", "i"), users, items


def named(df: DataFrame, **keys: DataFrame) -> DataFrame:
    """``df`` with the numbers in the named columns replaced by their keys:
    ``named(result, u=users, v=users, i=items)``."""
    cols = df.columns
    for col, index in keys.items():
        back = index.select(F.col("idx").alias(col), F.col("value").alias("_key"))
        df = df.join(back, col).drop(col).withColumnRenamed("_key", col)
    return df.select(*cols)


def event_item(props: str = "props") -> Column:
    """Item key of an event: ``props.k``."""
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


def entity_sets(inter: DataFrame, by: str = "u", other: str | None = None, most: int = MOST_ITEMS) -> DataFrame:
    """One sorted, distinct, non-empty set per entity (B2).

    Output ``(u, n, part, items)``.  ``by='i'`` turns the table around (item
    sets of users).  A set of more than ``most`` elements comes in several
    rows, ``part`` 0, 1, ..., each with about ``most`` of them, so that no row
    has to hold an unbounded set; all others have ``part`` 0 only.
    """
    other = other or ("i" if by == "u" else "u")
    rows = (inter.select(F.col(by).alias("u"), F.col(other).alias("x"))
            .where(F.col("u").isNotNull() & F.col("x").isNotNull()).distinct())
    sizes = cut_lineage(rows.groupBy("u").agg(F.count(F.lit(1)).alias("n")), "set-sizes")
    part = F.pmod(F.xxhash64("x"), F.ceil(F.col("n") / F.lit(most))).cast("int")
    return (rows.join(sizes, "u").withColumn("part", part).groupBy("u", "n", "part")
            .agg(F.array_sort(F.collect_list("x")).alias("items")))


def subset(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Deterministic subset: keep rows whose ``md5(key)`` falls below ``fraction``
    of the hash range (A2).

    All 128 bits are compared, so any fraction is met up to sampling noise.
    Rows with a null key are never in the subset.  Unlike ``sample`` it is the
    same on every engine and every run, and it is a plain filter, so it needs
    no shuffle.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    cut = int(Fraction(fraction) * (1 << 128))
    if cut >> 128:
        return df.where(F.col(key).isNotNull())
    return df.where(F.md5(F.col(key).cast("string")) < F.lit(format(cut, "032x")))
