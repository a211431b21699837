"""Count-min sketch of 64-bit keys, built per partition and merged by Spark.

Counters are only told apart as 0, 1 and "2 or more".  Every partition sends
its own cells, cut into shards and compressed; a shuffle on the shard merges
them.  The merged sketch overestimates, so a key that occurs twice is never
estimated as unique.  Its size is set from the number of keys and never
exceeds ``2 * MAX_WIDTH / 8`` bytes (128 MiB): beyond that it lets more unique
keys pass, which costs work but loses nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lshark.llm.common import in_task
from lshark.llm.hashing import U, mix

ROWS = 2
SHARDS = 64
MIN_WIDTH, MAX_WIDTH = 1 << 16, 1 << 29
FLUSH = 1 << 22
SCHEMA = "line int, shard int, cells binary"


def width_for(n_keys: float) -> int:
    """Power of two of at least four cells per key, within the bounds."""
    return min(MAX_WIDTH, max(MIN_WIDTH, 1 << int(np.ceil(np.log2(max(4.0 * n_keys, 1))))))


def cells(keys: np.ndarray, line: int, width: int) -> np.ndarray:
    return mix(keys ^ U(0x51ED270B9F4A7C15 * (line + 1) % (1 << 64))) & U(width - 1)


def _payloads(keys: np.ndarray, width: int):
    size = width // SHARDS
    for line in range(ROWS):
        u, n = np.unique(cells(keys, line, width), return_counts=True)
        cut = np.searchsorted(u, np.arange(SHARDS + 1, dtype=U) * U(size))
        for s in range(SHARDS):
            part = u[cut[s]:cut[s + 1]] - U(s * size)
            if len(part):
                code = (part << U(1)) | (n[cut[s]:cut[s + 1]] > 1).astype(U)
                yield line, s, zlib.compress(np.diff(code, prepend=U(0)).astype(np.uint32).tobytes(), 1)


def _rows(found) -> pa.RecordBatch:
    line, shard, data = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(line, pa.int32()), pa.array(shard, pa.int32()),
                                       pa.array(data, pa.binary())], names=["line", "shard", "cells"])


def merged(df: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], width: int) -> list[np.ndarray]:
    """Bit arrays (one per sketch line) of the cells counted twice or more.

    ``keys_of`` turns a record batch of ``df`` into arrays of keys.  At most
    ``ROWS * width / 8`` bytes reach the driver.
    """
    size = width // SHARDS

    def build(batches):
        held, n = [], 0
        for b in batches:
            for keys in keys_of(b):
                held.append(keys)
                n += len(keys)
                if n >= FLUSH:
                    yield _rows(_payloads(np.concatenate(held), width))
                    held, n = [], 0
        if n:
            yield _rows(_payloads(np.concatenate(held), width))

    def merge(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for line, shard, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                got = sums.setdefault((line, shard), np.zeros(size, np.uint8))
                code = np.cumsum(np.frombuffer(zlib.decompress(data), np.uint32).astype(np.int64))
                at = code >> 1
                got[at] = np.minimum(got[at] + 1 + (code & 1), 2)
        if sums:
            yield _rows([(k[0], k[1], zlib.compress(np.packbits(v > 1, bitorder="little").tobytes(), 1))
                         for k, v in sums.items()])

    parts = (df.mapInArrow(in_task(build), SCHEMA).repartition("line", "shard").mapInArrow(in_task(merge), SCHEMA))
    bits = [np.zeros(width // 8, np.uint8) for _ in range(ROWS)]
    for line, shard, data in parts.collect():
        bits[line][shard * size // 8:(shard + 1) * size // 8] = np.frombuffer(zlib.decompress(bytes(data)), np.uint8)
    return bits


def seen_twice(bits: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Whether the sketch estimates two or more occurrences of each key."""
    width, out = len(bits[0]) * 8, np.ones(len(keys), bool)
    for line, b in enumerate(bits):
        c = cells(keys, line, width)
        out &= (b[(c >> U(3)).astype(np.int64)] >> (c & U(7)).astype(np.uint8)) & 1 == 1
    return out
