"""Helpers shared by the operators: shipping the package, row keys, Arrow text access."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lshark import session
from lshark.session import cut_lineage

NULL_ID = -(1 << 63)
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors (:func:`lshark.session.ship`) and keep
    Arrow batches small where the session leaves their size at Spark's default,
    as whole texts are long."""
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "2000")
    session.ship(spark)


#: Rows of a written table that one task may write where their number is known.
FILE_ROWS = 50_000


def stage(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.  With a
    bound on its ``rows`` it is written by as few tasks as that many need, two a
    core at least, however many partitions a shuffle has."""
    if rows is not None:
        df = df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))
    return cut_lineage(df, f"llm-{name}")


def id_key(col: Column) -> Column:
    """A non-null bigint key: null ids become the smallest long (and sort first)."""
    return F.coalesce(col.cast("bigint"), F.lit(NULL_ID))


def id_back(col: Column) -> Column:
    return F.when(col != F.lit(NULL_ID), col)


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``(d, f, text)``: id key, content fingerprint and text (null text: empty);
    with ``carry`` also ``row``, the input row as a struct.

    ``(d, f)`` tells rows apart that share an id but not a text; rows equal in
    both get equal results, so they may share a key.  Other columns of the
    input are not carried, so their names cannot clash.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(id_key(F.col(id_col)).alias("d"), F.xxhash64(text).alias("f"), text.alias("text"),
                       *([F.struct("*").alias("row")] if carry else []))


def text_bytes(arr) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of an Arrow string column; nulls count as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if len(arr) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if arr.null_count:
        arr = pc.fill_null(arr, "" if not pa.types.is_binary(arr.type) else b"")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def ints(arr) -> np.ndarray:
    return arr.to_numpy(zero_copy_only=False)


def batch(names: list[str], cols: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array,)) else pa.array(c) for c in cols], names=names)


# ------------------------------------------------------------ memory of Python workers

_held: dict = {}


def remembered(key, make: Callable):
    """An object that stays in the Python worker for its later tasks, until a
    task of another operator starts there."""
    if key not in _held:
        _held[key] = make()
    return _held[key]


def start_task(keep) -> None:
    for key in [k for k in _held if k != keep]:
        del _held[key]


def end_task() -> None:
    """Give unused memory back to the system: workers live long, and share an
    executor's memory with its JVM."""
    pa.default_memory_pool().release_unused()
    if os.name == "posix" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def in_task(run: Callable, keep=None) -> Callable:
    """``run`` over a task's record batches, with memory tidied around it;
    ``keep`` names the remembered object that it uses."""
    def guarded(batches):
        start_task(keep)
        yield from run(batches)
        end_task()

    return guarded
