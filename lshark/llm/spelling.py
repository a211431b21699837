"""Spelling variants by a trie-node pair dictionary (operator 11).

A word ``A c B`` passes node ``A`` of the trie of all words and node ``B`` of
the trie of all reversed words.  Two words differ in one replaced code point
exactly if they share the pair ``(A, B)`` around one skipped position, and in
one inserted code point exactly if the pair around the skipped position of one
is the pair at a gap of the other.  So all neighbours meet as equal pairs of
integers, and nothing has to be checked afterwards.

1. Runs are counted inside the tasks and summed per word.
2. Words are sorted across the cluster and numbered as trie nodes, forward and
   reversed: a word adds a node for every prefix that it does not share with the
   word before it.  A sorted part starts its own numbers; where its first word
   shares prefixes with the last word of the part before, those few numbers are
   translated back (one path per part reaches the driver).
3. Each word gives a row for every skipped position and every gap.  A group of
   equal pairs holds at most one gap row and as many skip rows as there are
   letters, so it is bounded by the alphabet; it passes on to each member how
   many neighbours it has there and the best of them.  No pairs are written.
4. Every form has at least twice the count of its word, so chains are short;
   roots come by doubling pointers.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lshark.llm.common import batch, in_task, ship, stage

EDIT = 97                      # a run whose hash this divides loses a code point
SHORTEST = 5
FEWEST = 3
RATIO = 2
PIECE = 1 << 20                # bytes of a text read at once
HELD = 400_000                 # words that a task counts before it passes them on
PART_BITS = 40                 # nodes of a part count in so many bits

_RUN = re.compile("[a-z\u00C0-\u00FF]+")
_GAP = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")               # no run goes on over these
_OTHER = bytes(b for b in range(256) if b >= 0xC2 and b != 0xC3)     # lead bytes of other code points
# fixed values: bytes of runs where code points beyond ASCII are U+00C0 to U+00FF only
_SPACED = bytes(b if 0x61 <= b <= 0x7A or 0x80 <= b else 0x20 for b in bytes(range(256)).lower())


def runs(text: str):
    """Maximal runs of letters with A-Z lower-cased, as UTF-8, piece by piece."""
    raw = text.encode()
    s, n = 0, len(raw)
    while s < n:
        gap = _GAP.search(raw, s + PIECE)
        e = gap.start() if gap else n
        part, s = raw[s:e], e
        if len(part.translate(None, _OTHER)) == len(part):
            yield part.translate(_SPACED).split()
        else:
            yield [w.encode() for w in _RUN.findall(part.lower().decode())]


def edited(doc_id: str, run: bytes) -> bytes:
    """``run`` without one code point if the hash of both names says so."""
    h = zlib.crc32(run, zlib.crc32(f"{doc_id}:".encode()))
    if h % EDIT:
        return run
    w = run.decode()
    k = h % len(w)
    return (w[:k] + w[k + 1:]).encode()


def word_counts(docs: DataFrame, id_col: str, text_col: str, shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """``(word, n)`` of all edited runs of enough code points and occurrences."""
    def run(batches):
        total: dict[bytes, int] = {}

        def flush():
            words, n = list(total), list(total.values())
            total.clear()
            return batch(["word", "n"], [pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())])

        for b in batches:
            for doc, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True):
                seed = zlib.crc32(f"{doc}:".encode())
                for found in runs(text):
                    for w in found:
                        if len(w) < shortest:
                            continue
                        h = zlib.crc32(w, seed)
                        if h % EDIT == 0:
                            w = edited(doc, w)
                        total[w] = total.get(w, 0) + 1
                    if len(total) >= HELD:
                        yield flush()
        if total:
            yield flush()

    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"),
                        F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    each = texts.mapInArrow(in_task(run), "word string, n long").where(F.length("word") >= shortest)
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)


# ------------------------------------------------------------------ trie nodes

def shared(a: str, b: str) -> int:
    """Length of the common start of two words."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    k = 0
    while a[k] == b[k]:
        k += 1
    return k


def number(words, before: str = "", path=(0,), fresh: int = 1):
    """Trie nodes of rising words: per word the numbers of all its prefixes,
    the empty one first.  The root is 0, other nodes count from ``fresh``."""
    path = list(path)
    for w in words:
        k = shared(before, w)
        new = len(w) - k
        path = path[:k + 1] + list(range(fresh, fresh + new))
        before, fresh = w, fresh + new
        yield path


def trie(words: DataFrame, backward: bool, name: str) -> DataFrame:
    """``(word, nodes)`` with the trie's node of every prefix (``backward``: of
    every suffix, shortest first).  Numbers rise with the sorted words, so the
    last one also orders the words.  The words must be distinct."""
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.reverse("word") if backward else F.col("word")
    dealt = (words.select("word", key.alias("key")).repartitionByRange(parts, "key").sortWithinPartitions("key")
             .withColumn("part", F.spark_partition_id()))

    def run(batches):
        before, path, fresh = "", (0,), 1
        for b in batches:
            if not b.num_rows:
                continue
            keys, part = b.column("key").to_pylist(), int(b.column("part")[0].as_py())
            rows = list(number(keys, before, path, fresh))
            fresh = max(fresh, max(r[-1] for r in rows) + 1)
            before, path = keys[-1], rows[-1]
            sizes = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
            flat = np.fromiter((x for r in rows for x in r), np.int64, sizes[-1])
            flat = np.where(flat > 0, flat + (part << PART_BITS), 0)
            yield batch(["word", "part", "nodes"], [b.column("word"), b.column("part"), pa.ListArray.from_arrays(
                pa.array(sizes.astype(np.int32)), pa.array(flat))])

    local = stage(dealt.mapInArrow(in_task(run), "word string, part int, nodes array<long>"), name)
    key = F.reverse("word") if backward else F.col("word")
    edge = local.groupBy("part").agg(F.min(F.struct(key.alias("key"), "nodes")).alias("low"),
                                     F.max(F.struct(key.alias("key"), "nodes")).alias("high"))
    same = aliases(sorted((r["part"], tuple(r["low"]), tuple(r["high"])) for r in edge.collect()))
    if not same:
        return local.select("word", "nodes")
    known = spark.sparkContext.broadcast(same)

    def rename(batches):
        for b in batches:
            col = b.column("nodes")
            if isinstance(col, pa.ChunkedArray):
                col = col.combine_chunks()
            flat = col.flatten().to_numpy()
            olds = np.array(sorted(known.value), np.int64)
            news = np.array([known.value[k] for k in olds.tolist()], np.int64)
            at = np.minimum(np.searchsorted(olds, flat), len(olds) - 1)
            flat = np.where(olds[at] == flat, news[at], flat)
            off = col.offsets.to_numpy()
            yield batch(["word", "nodes"], [b.column("word"), pa.ListArray.from_arrays(
                pa.array(off - off[0]), pa.array(flat))])

    return local.select("word", "nodes").mapInArrow(in_task(rename), "word string, nodes array<long>")


def aliases(parts: list) -> dict[int, int]:
    """Numbers to replace, from ``(part, (first word, nodes), (last word,
    nodes))`` of rising parts: a part's first path continues the last path of
    the part before, as far as the words agree."""
    same: dict[int, int] = {}
    last = None
    for _, low, high in parts:
        if last is not None:
            for k in range(1, shared(last[0], low[0]) + 1):
                same[low[1][k]] = last[1][k]
        last = high[0], [same.get(x, x) for x in high[1]]
    return same


# ------------------------------------------------------------------ neighbours

def neighbours(words: DataFrame) -> DataFrame:
    """``(id, word, n, n_near, best)`` of distinct ``(word, n)``: how many words
    are one edit away, and the one of largest count, ``best`` being ``(n, -id)``.
    ``id`` is the word's own forward node; it rises in code-point order."""
    ahead = trie(words, False, "trie").withColumnRenamed("nodes", "p")
    back = trie(words, True, "reversed-trie").withColumnRenamed("nodes", "s")
    both = words.join(ahead, "word").join(back, "word").withColumn("id", F.element_at("p", -1))
    both = stage(both, "trie-pairs")

    def pairs(batches):
        for b in batches:
            if not b.num_rows:
                continue
            ids, n = b.column("id").to_numpy(), b.column("n").to_numpy()
            p, s = b.column("p"), b.column("s")
            size = np.diff(p.offsets.to_numpy())                  # length of each word, plus one
            pf, sf = p.flatten().to_numpy(), s.flatten().to_numpy()
            end = np.cumsum(size)
            row = np.repeat(np.arange(len(size)), size)
            at = np.repeat(end - size, size)
            k = np.arange(end[-1]) - at
            gap = sf[at + (size[row] - 1 - k)]
            inside = k < size[row] - 1
            skip = sf[(at + (size[row] - 2 - k))[inside]]
            # of equal neighbouring code points only the first is skipped for a shorter word
            letters = np.frombuffer("".join(w + "\0" for w in b.column("word").to_pylist()).encode("utf-32-le"), np.uint32)
            head = np.ones(len(letters), bool)
            head[1:] = (letters[1:] != letters[:-1]) | (k[1:] == 0)
            kind = np.concatenate((np.zeros(len(pf), np.int8), np.where(head[inside], 2, 1).astype(np.int8)))
            yield batch(["p", "s", "kind", "id", "n"],
                        [np.concatenate((pf, pf[inside])), np.concatenate((gap, skip)), kind,
                         np.concatenate((ids[row], ids[row[inside]])), np.concatenate((n[row], n[row[inside]]))])

    met = both.mapInArrow(in_task(pairs), "p long, s long, kind byte, id long, n long")
    # at most one gap row and one skip row per letter: bounded by the alphabet
    group = met.groupBy("p", "s").agg(F.collect_list(F.struct("n", (-F.col("id")).alias("m"), "kind")).alias("x")) \
        .where(F.size("x") > 1)
    group = group.select(F.array_sort(F.filter("x", lambda y: y["kind"] > 0)).alias("skip"),
                         F.filter("x", lambda y: y["kind"] == 0).alias("gap"))
    best = F.col("skip")[F.size("skip") - 1]
    second = F.get(F.col("skip"), F.size("skip") - 2)
    heads = F.filter("skip", lambda y: y["kind"] == 2)
    rows = group.withColumn("heads", heads)
    score = lambda y: F.struct(y["n"].alias("n"), y["m"].alias("m"))
    none = F.lit(None).cast("struct<n:bigint,m:bigint>")
    of_skip = F.transform("skip", lambda y: F.struct(
        (-y["m"]).alias("id"), (F.size("skip") - 1).cast("bigint").alias("k"),
        F.when(F.size("skip") < 2, none).when(y["m"] == best["m"], score(second)).otherwise(score(best)).alias("best")))
    of_heads = F.when(F.size("gap") > 0, F.transform("heads", lambda y: F.struct(
        (-y["m"]).alias("id"), F.lit(1).cast("bigint").alias("k"), score(F.col("gap")[0]).alias("best"))))
    of_gap = F.transform("gap", lambda y: F.struct(
        (-y["m"]).alias("id"), F.size("heads").cast("bigint").alias("k"),
        F.when(F.size("heads") > 0, score(F.get(F.col("heads"), F.size("heads") - 1))).otherwise(none).alias("best")))
    empty = F.array().cast("array<struct<id:bigint,k:bigint,best:struct<n:bigint,m:bigint>>>")
    found = rows.select(F.explode(F.filter(F.concat(of_skip, F.coalesce(of_heads, empty), of_gap),
                                           lambda y: y["k"] > 0)).alias("y")).select("y.*")
    near = found.groupBy("id").agg(F.sum("k").alias("n_near"), F.max("best").alias("best"))
    return both.select("id", "word", "n").join(near, "id", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)))


def roots(step: DataFrame) -> DataFrame:
    """``(id, root)`` of ``(id, to)``: where following ``to`` ends.  Pointers are
    doubled; as counts double along a chain, six rounds are the most."""
    now = stage(step, "forms")
    while True:
        onward = now.select(F.col("id").alias("to"), F.col("to").alias("next"))
        jumped = stage(now.join(onward, "to", "left").select("id", F.coalesce("next", "to").alias("to"),
                                                             F.col("next").isNotNull().alias("moved")), "forms")
        now = jumped.select("id", "to")
        if jumped.where("moved").isEmpty():
            return now.withColumnRenamed("to", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST,
             fewest: int = FEWEST, ratio: int = RATIO) -> DataFrame:
    """Spelling variants of the words of all texts: ``(word, form, root, n,
    n_near, form_n)``, one row per word.

    Runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased lose a code point
    where 97 divides their hash with the document id (a null id is the text
    ``null``).  Words have at least ``shortest`` code points and ``fewest``
    occurrences.  ``form`` is the near word (one code point inserted, deleted
    or replaced) of largest ``n``, of equals the smallest, if its ``n`` is
    ``ratio`` times the word's or more, else null; ``root`` ends the chain of
    forms.  Null and empty texts have no words; a row counts as often as it is
    repeated; texts are read whole, a megabyte at a time.  An empty table gives
    an empty result.  Other columns are not read.
    """
    ship(docs.sparkSession)
    words = stage(word_counts(docs, id_col, text_col, shortest, fewest), "words")
    near = neighbours(words)
    form = (F.col("best.n") >= ratio * F.col("n"))
    near = stage(near.select("id", "word", "n", "n_near", F.when(form, -F.col("best.m")).alias("to"),
                             F.when(form, F.col("best.n")).alias("form_n")), "near-words")
    ends = roots(near.where("to IS NOT NULL").select("id", "to"))
    name = near.select("id", "word")
    named = (near.where("to IS NOT NULL").select("id", "to").join(ends, "id")
             .join(name.select(F.col("id").alias("to"), F.col("word").alias("form")), "to")
             .join(name.select(F.col("id").alias("root"), F.col("word").alias("last")), "root")
             .select("id", "form", "last"))
    return (near.join(named, "id", "left")
            .select("word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n"))
