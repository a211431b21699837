"""Language identification with a byte convolutional network (operator 6).

A text is cut into windows of :data:`WINDOW` bytes, all of which are read.
Each window goes through byte embeddings, filters of several widths, a maximum
over positions and a softmax; a text's answer is the mean of its windows' log
probabilities, weighted by their bytes.  The network is trained in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lshark.llm.common import end_task, in_task, ship, start_task, text_bytes
from lshark.llm.quality import held_out

WINDOW = 256
WIDTHS, FILTERS, EMBED = (2, 3, 4), 16, 6
#: Documents used to fit, shared out evenly over the languages, and windows per
#: document; chosen by a hash of the id.  A language is learned from ``SHARE`` or more.
MAX_TRAIN, WINDOWS_PER_TEXT = 8_000, 4
SHARE = 20
SHORTEST = 16                # bytes from which a window is learned
EPOCHS, BATCH, STEP, DECAY = 4, 128, 0.01, 1e-5
LEAST_STEPS = 60             # few windows are gone through more often than EPOCHS times
CHUNK = 128                  # windows convolved at once
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def windows(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(windows, text of each, bytes in each)``; the last window of a text is
    filled with zeros, an empty text has none."""
    n = np.diff(off)
    per = -(-n // WINDOW)
    first = np.concatenate(([0], np.cumsum(per)))
    out = np.zeros(int(first[-1]) * WINDOW, np.uint8)
    out[np.arange(len(buf)) + np.repeat(first[:-1] * WINDOW - off[:-1], n)] = _LOWER[buf]
    text = np.repeat(np.arange(len(n)), per)
    used = np.minimum(n[text] - (np.arange(len(text)) - first[text]) * WINDOW, WINDOW)
    return out.reshape(-1, WINDOW), text, used


@dataclass
class Model:
    langs: list[str]
    embed: np.ndarray                # (256, EMBED)
    filters: list[np.ndarray]        # per width (width * EMBED, FILTERS)
    bias: np.ndarray                 # (len(WIDTHS) * FILTERS,)
    out: np.ndarray                  # (features, langs)
    out_bias: np.ndarray

    def _pooled(self, w: np.ndarray):
        """Pooled features and, per filter, the position of the maximum."""
        e = self.embed[w]
        flat = e.reshape(len(w), -1)
        best, at = [], []
        for width, weight in zip(WIDTHS, self.filters, strict=True):
            places = w.shape[1] - width + 1
            view = np.lib.stride_tricks.as_strided(
                flat, (len(w), places, width * EMBED), (flat.strides[0], EMBED * flat.itemsize, flat.itemsize))
            a = (np.ascontiguousarray(view).reshape(-1, width * EMBED) @ weight).reshape(len(w), places, FILTERS)
            best.append(a.max(axis=1))
            at.append(a)
        return np.concatenate(best, axis=1) + self.bias, at, flat

    def log_probs(self, w: np.ndarray) -> np.ndarray:
        out = []
        for k in range(0, len(w), CHUNK):
            z = np.maximum(self._pooled(w[k:k + CHUNK])[0], 0) @ self.out + self.out_bias
            z -= z.max(axis=1, keepdims=True)
            out.append(z - np.log(np.exp(z).sum(axis=1, keepdims=True)))
        return np.concatenate(out) if out else np.zeros((0, len(self.langs)))

    def predict(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best language (an index) and its probability per text; -1 and 0 without
        bytes or without learned languages."""
        n = len(off) - 1
        total, best, score = np.zeros((n, len(self.langs))), np.full(n, -1), np.zeros(n)
        if not self.langs:
            return best, score
        i = 0
        while i < n:
            j = max(int(np.searchsorted(off, off[i] + CHUNK * WINDOW, "right")) - 1, i + 1)
            w, text, used = windows(buf[off[i]:off[j]], off[i:j + 1] - off[i])
            lp = self.log_probs(w) * used[:, None]
            for c in range(len(self.langs)):
                total[i:j, c] = np.bincount(text, lp[:, c], j - i)
            i = j
        size = np.diff(off)
        known = size > 0
        if known.any():
            z = total[known] / size[known][:, None]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            best[known], score[known] = p.argmax(axis=1), p.max(axis=1)
        return best, score


def fit_network(w: np.ndarray, y: np.ndarray, langs: list[str], seed: int = 7) -> Model:
    """Train on windows ``w`` with language indices ``y`` by Adam."""
    rng = np.random.default_rng(seed)
    f = len(WIDTHS) * FILTERS
    m = Model(langs, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
              [rng.normal(0, (width * EMBED) ** -0.5, (width * EMBED, FILTERS)).astype(np.float32) for width in WIDTHS],
              np.zeros(f, np.float32), rng.normal(0, f ** -0.5, (f, len(langs))).astype(np.float32),
              np.zeros(len(langs), np.float32))
    m.embed[0] = 0
    params = [m.embed, *m.filters, m.bias, m.out, m.out_bias]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    rounds = -(-len(w) // BATCH)
    for _ in range(max(EPOCHS, -(-LEAST_STEPS // rounds)) if rounds else 0):
        order = rng.permutation(len(w))
        for k in range(0, len(w), BATCH):
            b = order[k:k + BATCH]
            raw, planes, flat = m._pooled(w[b])
            x = np.maximum(raw, 0)
            z = x @ m.out + m.out_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            z[np.arange(len(b)), y[b]] -= 1
            z /= len(b)
            back = (z @ m.out.T) * (raw > 0)
            grad_embed, grad_filters = np.zeros_like(m.embed), []
            for n, width in enumerate(WIDTHS):
                g = back[:, n * FILTERS:(n + 1) * FILTERS]
                at = planes[n].argmax(axis=1)                                   # (batch, filters)
                place = at[:, :, None] * EMBED + np.arange(width * EMBED)
                patch = np.take_along_axis(flat, place.reshape(len(b), -1), axis=1).reshape(*at.shape, -1)
                grad_filters.append(np.einsum("bf,bfk->kf", g, patch))
                spread = (g[:, :, None] * m.filters[n].T[None]).reshape(-1, EMBED)
                bytes_at = np.take_along_axis(w[b], (at[:, :, None] + np.arange(width)).reshape(len(b), -1), axis=1)
                np.add.at(grad_embed, bytes_at.ravel(), spread)
            grad_embed[0] = 0                                                  # filling stays neutral
            t += 1
            for p, a, v, g in zip(params, first, second, [grad_embed, *grad_filters, back.sum(axis=0), x.T @ z,
                                                          z.sum(axis=0)], strict=True):
                g = g + DECAY * p
                a += 0.1 * (g - a)
                v += 0.001 * (g * g - v)
                p -= STEP * (a / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return m


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_train: int = MAX_TRAIN) -> Model:
    """Fit on windows of documents that are not held out and have a language and
    a text of at least ``SHORTEST`` bytes: of each language at most an even share
    of ``max_train``, so a rare language is learned however large the others are.
    A share is ``SHARE`` documents at least; of more languages than that allows
    the largest are learned (of equals the first by name), and the others are
    not among the model's ``langs``.  So at most ``max_train`` documents reach
    the driver, with ``WINDOWS_PER_TEXT`` windows each.  Windows are spread over
    each text; those of languages with fewer than the average are repeated up to
    it.  Null texts, null languages and other columns are not learned from; rows
    that repeat an id and a language count once.  Without a document to learn
    from the model knows no language and answers ``und``."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            w, text, used = windows(*text_bytes(b.column("text")))
            rank = np.arange(len(text)) - np.searchsorted(text, text)
            n = np.bincount(text, minlength=b.num_rows)[text] if len(text) else text
            step = np.maximum(n // WINDOWS_PER_TEXT, 1)
            k = np.flatnonzero((rank % step == 0) & (rank // step < WINDOWS_PER_TEXT) & (used >= SHORTEST))
            take = pa.array(text[k])
            yield pa.RecordBatch.from_arrays(
                [b.column("d").take(take), b.column("lang").take(take), pa.array(rank[k]),
                 pa.array([x.tobytes() for x in w[k]], pa.binary())], names=["d", "lang", "place", "bytes"])

    known = docs.select(F.col(id_col).cast("string").alias("d"), F.col(lang_col).cast("string").alias("lang"),
                        F.col(text_col).cast("string").alias("text"))
    known = known.where(F.col("lang").isNotNull() & (F.octet_length("text") >= SHORTEST) & ~held_out(F.col("d")))
    largest = [r["lang"] for r in known.groupBy("lang").agg(F.count("*").alias("n"))
               .orderBy(F.desc("n"), "lang").limit(max(max_train // SHARE, 1)).collect()]
    known = known.where(F.col("lang").isin(largest)) if largest else known.limit(0)
    share = max_train // max(len(largest), 1)
    # ids alone are ranked, at most ``share`` per task and language are shuffled; the
    # texts are then read by a semi-join with that bounded list
    order = Window.partitionBy("lang").orderBy(F.xxhash64("d"), "d")
    chosen = (known.select("lang", "d").distinct().withColumn("place", F.row_number().over(order))
              .where(F.col("place") <= share).select("lang", "d"))
    rows = (known.join(F.broadcast(chosen), ["lang", "d"], "left_semi")
            .groupBy("d", "lang").agg(F.min("text").alias("text"))       # one row of each
            .mapInArrow(in_task(run), "d string, lang string, place long, bytes binary").toArrow())
    rows = rows.sort_by([("d", "ascending"), ("place", "ascending"), ("lang", "ascending"), ("bytes", "ascending")])
    langs = sorted(set(rows["lang"].to_pylist()))
    w = np.frombuffer(b"".join(rows["bytes"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    number = {x: k for k, x in enumerate(langs)}
    y = np.array([number[x] for x in rows["lang"].to_pylist()], np.int64)
    own = [np.flatnonzero(y == k) for k in range(len(langs))]
    each = -(-len(y) // max(len(langs), 1))
    take = np.concatenate([np.resize(k, max(len(k), each)) for k in own]) if own else y
    return fit_network(w[take], y[take], langs)


def identify(model: Model, text: Column) -> Column:
    """Struct ``(lang, score)`` of a text column: ``und`` with score 0 for null
    texts and texts without a letter (any script), else a learned language."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("lang string, score double")
    def found(v: pa.Array) -> pa.Array:
        start_task(None)
        best, score = model.predict(*text_bytes(v))
        end_task()
        names = [model.langs[k] if k >= 0 else UNKNOWN for k in best.tolist()]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score)], names=["lang", "score"])

    text = text.cast("string")
    lettered = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    got = found(F.when(lettered, text).otherwise(F.lit("")))
    return got
