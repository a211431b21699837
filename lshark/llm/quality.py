"""Quality classifier: histogram gradient-boosted trees over document statistics (operator 1).

Statistics of whole texts are computed from the bytes of an Arrow batch with
numpy (no loop over words).  Trees are grown level by level on binned features
and kept as arrays of complete binary trees, so scoring is a few array
look-ups per level for all texts at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lshark.llm import hashing
from lshark.llm.common import end_task, in_task, ship, start_task, text_bytes

#: Labelled rows used to fit, at most; chosen by a hash of the id.
MAX_TRAIN = 20_000
TREES, DEPTH, BINS, RATE, LEAF, L2 = 120, 5, 64, 0.1, 20, 1.0
PART = 1 << 19               # bytes of text examined at once

_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "high": range(128, 256),
    "space": b" ", "break": b"\n\r", "tab": b"\t", "stop": b".", "comma": b",", "bang": b"!?", "quote": b"'\"`",
    "mark": b"#$%&*+=^~_", "frame": b"|\\/<>[]{}()", "link": b"@:;-",
}
FEATURES = ["log_bytes", "log_words", *(f"{c}_share" for c in _CLASSES), "byte_entropy", "word_mean", "word_deviation",
            "word_longest", "word_distinct", "word_top", "word_repeats_previous", "pair_distinct", "triple_repeated",
            "marked_words", "capital_words", "title_words", "letterless_words", "log_lines", "line_mean",
            "line_repeated", "line_bytes_repeated", "stops_per_word"]

_member = np.zeros((256, len(_CLASSES)))
for _k, _bytes in enumerate(_CLASSES.values()):
    _member[list(_bytes), _k] = 1
_UPPER, _DIGIT = np.zeros(256, np.int8), np.zeros(256, np.int8)
_UPPER[65:91] = _DIGIT[48:58] = 1
_LETTER = np.zeros(256, np.int8)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_MARK = np.zeros(256, np.int8)
_MARK[list(b"!?#$%&*+=^~_|\\/<>[]{}()@")] = 1


def _ratio(a, b):
    a = np.asarray(a, float)
    return np.divide(a, b, out=np.zeros(len(a)), where=np.asarray(b) > 0)


def _repeats(h: np.ndarray, text: np.ndarray, n: int, weight=None):
    """Per text: distinct values, occurrences of the commonest, weight of occurrences after the first."""
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(h)))
    top = np.zeros(n)
    np.maximum.at(top, text[at], count)
    again = ~new
    extra = np.bincount(text[again], None if weight is None else weight[order][again], n)
    return np.bincount(text[at], minlength=n), top, extra


def _statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    n, size = len(off) - 1, np.diff(off).astype(float)
    of_byte = np.repeat(np.arange(n), np.diff(off))
    hist = np.bincount(of_byte * 256 + buf, minlength=n * 256).reshape(n, 256).astype(float)
    share = _ratio((hist @ _member).ravel(), np.repeat(size, len(_CLASSES))).reshape(n, -1)
    p = hist / np.maximum(size, 1)[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)

    start, end, count = hashing.words(buf, off)
    word = np.repeat(np.arange(n), count)
    length = (end - start).astype(float)
    prefix = hashing.Prefix(hashing.byte_table()[buf])
    h = prefix.ranges(start, end)
    words = count.astype(float)
    mean = _ratio(np.bincount(word, length, n), words)
    deviation = np.sqrt(np.maximum(_ratio(np.bincount(word, length ** 2, n), words) - mean ** 2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, word, length)
    distinct, top, _ = _repeats(h, word, n)
    previous = np.zeros(len(h), bool)
    previous[1:] = (h[1:] == h[:-1]) & (word[1:] == word[:-1])
    grams = hashing.Prefix(h)

    def runs(k):
        g = grams.grams(k)
        inside = word[k - 1:] == word[:len(g)] if len(g) else np.zeros(0, bool)
        return g[inside], word[:len(g)][inside]

    pairs, pair_text = runs(2)
    pair_distinct, _, _ = _repeats(pairs, pair_text, n)
    triples, triple_text = runs(3)
    _, _, triple_again = _repeats(triples, triple_text, n)

    def per_word(table):
        c = np.concatenate(([0], np.cumsum(table[buf], dtype=np.int64)))
        return c[end] - c[start]

    letters, upper, marks = per_word(_LETTER), per_word(_UPPER), per_word(_MARK)
    share_of = lambda flags: _ratio(np.bincount(word[flags], minlength=n), words)

    breaks = np.flatnonzero(buf == 10)
    edge = np.unique(np.concatenate((off, breaks + 1)))
    line_start, line_end = edge[:-1], edge[1:]
    line = np.searchsorted(off, line_start, "right") - 1
    line_size = (line_end - line_start).astype(float)
    stripped = line_end - (buf[np.maximum(line_end - 1, 0)] == 10) if len(buf) else line_end
    lines = np.bincount(line, minlength=n)
    _, _, again = _repeats(prefix.ranges(line_start, stripped), line, n)
    _, _, bytes_again = _repeats(prefix.ranges(line_start, stripped), line, n, line_size)
    return np.column_stack([
        np.log1p(size), np.log1p(words), share, entropy, mean, deviation, np.log1p(longest), _ratio(distinct, words),
        _ratio(top, words), _ratio(np.bincount(word[previous], minlength=n), words),
        _ratio(pair_distinct, np.maximum(words - 1, 0)), _ratio(triple_again, np.maximum(words - 2, 0)),
        share_of(marks > 0), share_of((upper == letters) & (letters > 1)),
        share_of((_UPPER[buf[start]] == 1) & (upper == 1)) if len(start) else np.zeros(n), share_of(letters == 0),
        np.log1p(lines), _ratio(size, lines), _ratio(again, lines), _ratio(bytes_again, size),
        _ratio(hist[:, 46], words)])


def statistics(texts) -> np.ndarray:
    """One row of :data:`FEATURES` per text of an Arrow column, over whole texts."""
    buf, off = text_bytes(texts)
    out = [np.zeros((0, len(FEATURES)))]
    i = 0
    while i < len(off) - 1:
        j = max(int(np.searchsorted(off, off[i] + PART, "right")) - 1, i + 1)
        out.append(_statistics(buf[off[i]:off[j]], off[i:j + 1] - off[i]))
        i = j
    return np.concatenate(out)


# ------------------------------------------------------------------ boosted trees


@dataclass
class Model:
    """``cuts[f]`` are the bin borders of feature ``f``; tree nodes are numbered
    as in a heap, a node without a split sends everything left."""
    cuts: list[np.ndarray]
    feature: np.ndarray      # (trees, inner nodes)
    border: np.ndarray       # go right if the bin is above it
    leaf: np.ndarray         # (trees, leaves)
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(_binned(x, self.cuts))))

    def margin(self, bins: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(bins), self.base), np.arange(len(bins))
        depth = self.leaf.shape[1].bit_length() - 1
        for feature, border, leaf in zip(self.feature, self.border, self.leaf, strict=True):
            node = np.zeros(len(bins), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (bins[rows, feature[node]] > border[node])
            total += leaf[node - (len(leaf) - 1)]
        return total


def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(c, x[:, k]) for k, c in enumerate(cuts)]).astype(np.uint8) if len(x) \
        else np.zeros((0, len(cuts)), np.uint8)


def _grow(bins, grad, hess, depth, n_bins, leaf_min, l2):
    """One tree, level by level, from histograms of gradients and curvatures."""
    n, m = bins.shape
    inner = (1 << depth) - 1
    feature, border = np.zeros(inner, np.int64), np.full(inner, n_bins, np.int64)
    node = np.zeros(n, np.int64)
    column = np.arange(m) * n_bins
    rows = np.arange(n)
    for level in range(depth):
        first, width = (1 << level) - 1, 1 << level
        slot = ((node - first)[:, None] * (m * n_bins) + column + bins).ravel()
        shape = (width, m, n_bins)
        total = [np.bincount(slot, np.repeat(v, m), width * m * n_bins).reshape(shape).cumsum(axis=2)
                 for v in (grad, hess, np.ones(n))]
        (g, h, c), (ga, ha, ca) = total, (t[:, :, -1:] for t in total)
        gain = g ** 2 / (h + l2) + (ga - g) ** 2 / (ha - h + l2) - ga ** 2 / (ha + l2)
        gain = np.where((c >= leaf_min) & (ca - c >= leaf_min), gain, 0).reshape(width, -1)
        best = gain.argmax(axis=1)
        good = gain[np.arange(width), best] > 1e-9
        at = first + np.flatnonzero(good)
        feature[at], border[at] = best[good] // n_bins, best[good] % n_bins
        node = 2 * node + 1 + (bins[rows, feature[node]] > border[node])
    where = node - inner
    return feature, border, where, -np.bincount(where, grad, inner + 1) / (np.bincount(where, hess, inner + 1) + l2)


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, n_bins: int = BINS,
              rate: float = RATE, leaf_min: int = LEAF, l2: float = L2) -> Model:
    """Boosted trees for logistic loss.  Without rows, or with one label only,
    the model is a constant."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, k], np.arange(1, n_bins) / n_bins)) if len(x) else np.zeros(1)
            for k in range(x.shape[1])]
    found = []
    if len(y) and 0 < y.sum() < len(y):
        bins, margin = _binned(x, cuts), np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            feature, border, where, leaf = _grow(bins, p - y, p * (1 - p), depth, n_bins, leaf_min, l2)
            margin += rate * leaf[where]
            found.append((feature, border, rate * leaf))
    f, b, v = zip(*found, strict=True) if found else ([], [], [])
    inner = (1 << depth) - 1
    return Model(cuts, np.array(f, np.int64).reshape(-1, inner), np.array(b, np.int64).reshape(-1, inner),
                 np.array(v, float).reshape(-1, inner + 1), base)


# ------------------------------------------------------------------ on Spark


def held_out(id_col: Column) -> Column:
    """Rows never learned from: crc32 of the id as text divisible by 5 (null ids too)."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` labelled, not held-out documents.

    A document labelled more than once counts with the highest label; null
    labels are left out; of rows that repeat an id, the smallest text counts.
    Features are computed by the executors; at most
    ``max_train`` rows of :data:`FEATURES` reach the driver.
    """
    ship(docs.sparkSession)
    known = (labels.select(F.col(id_col).alias("d"), F.col(label_col).alias("y"))
             .where(F.col("y").isNotNull() & ~held_out(F.col("d"))).groupBy("d").agg(F.max("y").alias("y")))
    known = known.orderBy(F.xxhash64("d"), "d").limit(max_train)

    def run(batches):
        for b in batches:
            x = statistics(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("d"), b.column("y"), pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)), pa.array(x.ravel()))],
                names=["d", "y", "x"])

    texts = docs.select(F.col(id_col).alias("d"), F.col(text_col).cast("string").alias("text"))
    rows = (texts.join(F.broadcast(known), "d")               # at most max_train ids and labels
            .groupBy("d", "y").agg(F.min("text").alias("text"))  # one text of each
            .select(F.col("d").cast("string").alias("d"), F.col("y").cast("double").alias("y"), "text")
            .mapInArrow(in_task(run), "d string, y double, x array<double>"))
    table = rows.toArrow()
    x = np.array(table["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    y, d = table["y"].to_numpy(), np.array(table["d"].to_pylist(), object)
    order = np.lexsort((*x.T[:2], d.astype(str))) if len(y) else np.zeros(0, int)
    return fit_trees(x[order], y[order])


def score(model: Model, text: Column) -> Column:
    """Score of a text column, 0 to 1; null and empty texts are scored as empty."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("double")
    def scored(v: pa.Array) -> pa.Array:
        start_task(None)
        out = pa.array(model.score(statistics(v)))
        end_task()
        return out

    return scored(F.coalesce(text.cast("string"), F.lit("")))
