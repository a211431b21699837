"""Vectorised hashing of byte and word sequences (numpy, inside tasks).

Sequences are hashed with a polynomial over 64-bit integers whose value for
any range comes from one prefix sum, and a finishing mix.  All of it is
deterministic: equal content gives equal hashes on every executor.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
POS_BITS = 24
POS_MASK = U((1 << POS_BITS) - 1)
SEGMENT = 1 << 19            # units hashed at once; below 2**POS_BITS
PIECE = 1 << 20              # bytes of one text parsed into words at once

_tables: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finisher, in place."""
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def byte_table() -> np.ndarray:
    if "bytes" not in _tables:
        _tables["bytes"] = mix(np.arange(1, 257, dtype=U) * U(0xD6E8FEB86659FD93))
    return _tables["bytes"]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("pow", ())) < n:
        m = max(n, 1 << 16)
        for name, base in (("pow", BASE), ("inv", INVERSE)):
            t = np.full(m, base, dtype=U)
            t[0] = 1
            _tables[name] = np.multiply.accumulate(t)
    return _tables["pow"][:n], _tables["inv"][:n]


class Prefix:
    """Hashes of any range of ``units`` after one pass."""

    def __init__(self, units: np.ndarray):
        self.n = len(units)
        p, self.inv = powers(self.n + 1)
        self.c = np.zeros(self.n + 1, U)
        np.cumsum(units * p[:self.n], out=self.c[1:])

    def grams(self, k: int) -> np.ndarray:
        """Hash of every run of ``k`` units, by start."""
        if self.n < k:
            return np.empty(0, U)
        g = self.c[k:] - self.c[:-k]
        g *= self.inv[:len(g)]
        return mix(g)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        g = (self.c[end] - self.c[start]) * self.inv[start]
        g += (end - start).astype(U) * U(0xA24BAED4963EE407)
        return mix(g)


WORD = np.ones(256, bool)
WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and number per text of the words ``[^\\x20\\x09-\\x0D]+``."""
    n = len(buf)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(off) - 1, np.int64)
    is_word = WORD[buf]
    before = np.zeros(n, bool)
    before[1:] = is_word[:-1]
    before[off[:-1][off[:-1] < n]] = False
    starts = np.flatnonzero(is_word & ~before)
    after = np.zeros(n, bool)
    after[:-1] = is_word[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    ends = np.flatnonzero(is_word & ~after) + 1
    return starts, ends, np.diff(np.searchsorted(starts, off))


def _hash_words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, counts = words(buf, off)
    if not len(starts):
        return np.empty(0, U), counts
    return Prefix(byte_table()[buf]).ranges(starts, ends), counts


def word_hashes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hash of every word, word offsets per text)``.  Texts are parsed a few
    megabytes at a time; a longer text is cut at separators, never in a word."""
    hashes, counts = [], np.zeros(len(off) - 1, np.int64)
    for i, j, s, e in segments(off, 1, PIECE):
        if s != off[i] or e != off[j]:
            continue                                   # parts of a long text: below
        h, c = _hash_words(buf[s:e], off[i:j + 1] - s)
        hashes.append((i, h))
        counts[i:j] = c
    for i in np.flatnonzero(np.diff(off) > PIECE):
        s, parts = int(off[i]), []
        while s < off[i + 1]:
            e = min(s + PIECE, int(off[i + 1]))
            while e < off[i + 1] and WORD[buf[e]]:
                stop = min(e + 4096, int(off[i + 1]))
                gap = np.flatnonzero(~WORD[buf[e:stop]])
                e = e + int(gap[0]) if len(gap) else stop
            parts.append(_hash_words(buf[s:e], np.array([0, e - s]))[0])
            s = e
        hashes.append((i, np.concatenate(parts)))
        counts[i] = len(hashes[-1][1])
    hashes.sort(key=lambda x: x[0])
    return (np.concatenate([h for _, h in hashes]) if hashes else np.empty(0, U),
            np.concatenate(([0], np.cumsum(counts))))


def segments(off: np.ndarray, length: int, limit: int = SEGMENT):
    """Cut texts into parts of about ``limit`` units: ``(first, last + 1, start,
    end)``, several whole texts or a stretch of one long text.  Stretches
    overlap by ``length - 1`` so that each window is in exactly one."""
    i, last = 0, len(off) - 1
    while i < last:
        if off[i + 1] - off[i] > limit:
            s = int(off[i])
            while True:
                e = min(s + limit, int(off[i + 1]))
                yield i, i + 1, s, e
                if e == off[i + 1]:
                    break
                s = e - (length - 1)
            i += 1
        else:
            j = max(int(np.searchsorted(off, off[i] + limit, "right")) - 1, i + 1)
            yield i, j, int(off[i]), int(off[j])
            i = j


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours, by doubling."""
    m, size = x, 1
    while size * 2 <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    rest = w - size
    return np.minimum(m[:-rest], m[rest:]) if rest else m


def anchor_runs(units: np.ndarray, off: np.ndarray, length: int, q: int):
    """Runs of neighbouring windows of ``length`` units with one common anchor.

    The anchor of a window is its ``q``-gram with the smallest hash (the first
    of equals), so it depends on the window's content alone: equal windows
    have equal anchors at the same place.  Returns ``(text, start, windows,
    anchor hash, content hash, anchor place from the start)`` per run, the
    content being all units that the run's windows cover, and the
    :class:`Prefix`.
    """
    n, p = len(units), Prefix(units)
    if n < length:
        e = np.empty(0, np.int64)
        return e, e, e, np.empty(0, U), np.empty(0, U), e, p
    g = p.grams(q)
    key = (g & ~POS_MASK) | np.arange(len(g), dtype=U)
    low = sliding_min(key, length - q + 1)
    limit = np.repeat(off[1:], np.diff(off))[:len(low)]
    s = np.flatnonzero(np.arange(length, length + len(low)) <= limit)
    if not len(s):
        e = np.empty(0, np.int64)
        return e, e, e, np.empty(0, U), np.empty(0, U), e, p
    a = (low[s] & POS_MASK).astype(np.int64)
    new = np.ones(len(s), bool)
    new[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1] + 1)
    at = np.flatnonzero(new)
    first, count = s[at], np.diff(np.append(at, len(s)))
    text = np.searchsorted(off, first, "right") - 1
    return text, first, count, g[a[at]], p.ranges(first, first + count - 1 + length), a[at] - first, p
