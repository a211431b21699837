"""Substring dedup over word windows (operator 8).

Every window of ``length`` words that also starts earlier in the corpus
(smaller id, or same id and earlier start) is covered for removal; the words
left over are the kept text.

1. *Count-min prefilter.*  Windows are counted by their anchor, the 8-gram
   with the smallest hash inside the window: equal windows share it, so the
   anchor's count is never below the window's.  Each partition builds a
   sketch of its anchors, Spark merges them.
2. *Exact pass.*  Only windows whose anchor is estimated to repeat are
   emitted, as runs of neighbouring windows with one anchor.  Runs of equal
   content are grouped first (a group of a million copies is one row); where
   one anchor still has different contents, their windows are grouped one by
   one.  Groups keep a minimum and no list, so no group has to fit a task.

Windows and contents are told apart by 128 bits of hash (anchor and content).
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lshark.llm import hashing, sketch
from lshark.llm.common import batch, id_back, in_task, ints, keyed_texts, ship, stage, text_bytes

LENGTH = 20
ANCHOR = 8


def _runs(b: pa.RecordBatch, length: int, q: int):
    """Per part of a record batch: row, word start, windows, anchor, content, prefix."""
    units, off = hashing.word_hashes(*text_bytes(b.column("text")))
    for i, j, s, e in hashing.segments(off, length):
        local = np.clip(off[i:j + 1] - s, 0, e - s)
        text, first, n, h, c, _, p = hashing.anchor_runs(units[s:e], local, length, q)
        if len(first):
            yield text + i, first + s - off[text + i], n, h, c, p, first


def repeated_runs(texts: DataFrame, length: int = LENGTH, q: int = ANCHOR) -> DataFrame:
    """Runs whose anchor the sketch estimates to repeat:
    ``(d, f, pos, n, h, c, w)``, ``w`` the hashes of the run's windows."""
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = sketch.width_for(size / 5 * 2 / (length - q + 2))
    bits = spark.sparkContext.broadcast(sketch.merged(
        texts.select("text"), lambda b: (x[3] for x in _runs(b, length, q)), width))

    def emit(batches):
        for b in batches:
            d, f = ints(b.column("d")), ints(b.column("f"))
            for row, pos, n, h, c, p, first in _runs(b, length, q):
                k = np.flatnonzero(sketch.seen_twice(bits.value, h))
                if not len(k):
                    continue
                w = p.grams(length).view(np.int64)
                ends = np.cumsum(n[k])
                at = np.arange(ends[-1]) + np.repeat(first[k] - (ends - n[k]), n[k])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(w[at]))
                yield batch(["d", "f", "pos", "n", "h", "c", "w"],
                            [d[row[k]], f[row[k]], pos[k], n[k], h[k].view(np.int64), c[k].view(np.int64), lists])

    return texts.mapInArrow(in_task(emit), "d long, f long, pos long, n long, h long, c long, w array<long>")


def removal_spans(texts: DataFrame, length: int = LENGTH, q: int = ANCHOR) -> DataFrame:
    """``(d, f, s, e)``: word ranges to remove (they may overlap)."""
    runs = stage(repeated_runs(texts, length, q), "runs")
    place = F.struct("d", "pos")
    ends = F.min(place).alias("first"), F.max(place).alias("last")
    groups = stage(runs.groupBy("h", "c").agg(*ends), "groups")
    span = [F.col("pos").alias("s"), (F.col("pos") + F.col("n") - 1 + length).alias("e")]
    # a run whose content also starts earlier goes as a whole
    later = (runs.drop("w").join(groups.where("first < last"), ["h", "c"])
             .where(place > F.col("first")).select("d", "f", *span))
    # anchors with several contents: compare the windows of each content's first run
    mixed = stage(groups.groupBy("h").agg(F.count("*").alias("k")).where("k > 1").select("h"), "mixed")
    heads = (groups.join(mixed, "h").select("h", "c", F.col("first.d").alias("d"), F.col("first.pos").alias("pos")))
    windows = (runs.join(heads, ["h", "c", "d", "pos"])
               .select("d", "f", "pos", "h", F.posexplode("w").alias("i", "w"))
               .select("d", "f", (F.col("pos") + F.col("i")).alias("pos"), "h", "w"))
    windows = stage(windows, "windows")
    firsts = stage(windows.groupBy("h", "w").agg(*ends).where("first < last").select("h", "w", "first"), "firsts")
    covered = (windows.join(firsts, ["h", "w"]).where(place > F.col("first"))
               .select("d", "f", F.col("pos").alias("s"), (F.col("pos") + length).alias("e")))
    return later.unionByName(covered)


def _covered(n: int, spans) -> np.ndarray:
    """Boolean mask of the units under any span."""
    edge = np.zeros(n + 1, np.int64)
    for s, e in spans:
        edge[s] += 1
        edge[min(e, n)] -= 1
    return np.cumsum(edge[:n]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, q: int = ANCHOR, carry: bool = False) -> DataFrame:
    """Kept words of every text: ``(id, n_words, n_removed, kept)``; with
    ``carry`` also ``row``, the input row as a struct.

    ``kept`` joins the kept words by one space.  Null texts have no words; a
    text shorter than ``length`` words loses none.  Null ids come before all
    others.  Rows that repeat both id and text are one place, so neither is
    earlier than the other.  An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    spans = (removal_spans(keyed_texts(docs, id_col, text_col), length, q).groupBy("d", "f")
             .agg(F.collect_set(F.struct("s", "e")).alias("spans")))        # once, however many rows repeat a text
    spans = stage(spans, "spans")                 # the runs' shuffles are gone before texts are shuffled

    def apply(batches):
        for b in batches:
            found = b.column("spans").to_pylist()
            buf, off = text_bytes(b.column("row").field(text_col) if carry else b.column("text"))
            n_words, removed, kept = [], [], []
            for i, spans in enumerate(found):
                ws = buf[off[i]:off[i + 1]].tobytes().split()
                n_words.append(len(ws))
                removed.append(0)
                if spans:
                    mask = _covered(len(ws), [(x["s"], x["e"]) for x in spans])
                    removed[-1] = int(mask.sum())
                    ws = compress(ws, (~mask).tolist())
                kept.append(b" ".join(ws).decode())
            more = [b.column("row")] if carry else []
            yield batch(["d", "n_words", "n_removed", "kept", "row"][:4 + carry],
                        [b.column("d"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
                         pa.array(kept, pa.string()), *more])

    rows = keyed_texts(docs, id_col, text_col, carry)
    joined = rows.drop("text" if carry else "row").join(spans, ["d", "f"], "left").drop("f")
    schema = T.StructType([T.StructField("d", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    if carry:
        schema.add("row", rows.schema["row"].dataType)
    out = joined.mapInArrow(in_task(apply), schema)
    return out.withColumn("d", id_back(F.col("d"))).withColumnRenamed("d", id_col)


def digest(kept: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return kept.select(id_col, "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
