"""Quality classifier and language identification on held-out rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lshark.llm import langid, quality, queries

SMALL = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_quality_on_held_out_documents(spark):
    got = {r.doc_id: r for r in queries.op1_quality_classifier(spark, SMALL).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = [(got[d].score, y) for d, y in labels.items() if held(d)]
    assert all(r.held_out == held(d) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for d, r in got.items())
    good, bad = [s for s, y in rows if y], [s for s, y in rows if not y]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([(s >= 0.3) == bool(y) for s, y in rows]) > 0.95


def test_labels_of_held_out_documents_change_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 300")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    other = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality"))
                              .otherwise(F.col("quality")))
    a, b = quality.fit(docs, labels), quality.fit(docs, other)
    assert (a.leaf == b.leaf).all() and (a.feature == b.feature).all() and len(a.leaf)


def test_statistics_do_not_depend_on_neighbours():
    rnd = random.Random(1)
    texts = ["", "a", "Same same\nSame same\n", None, " \n\t", "é!!" * 40, "x" * 5000]
    texts += [" ".join(rnd.choice(["ab", "Cd!", "E", "12", "\n"]) for _ in range(rnd.randrange(200))) for _ in range(20)]
    whole = quality.statistics(pa.array(texts))
    alone = np.concatenate([quality.statistics(pa.array([t], pa.string())) for t in texts])
    assert np.isfinite(whole).all() and np.allclose(whole, alone, atol=1e-12)


def test_flat_trees_score_as_grown():
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_trees(x, y, trees=30, depth=3)
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.95
    bins = quality._binned(x, model.cuts)
    for row in range(0, 600, 97):                       # one node at a time
        total = model.base
        for feature, border, leaf in zip(model.feature, model.border, model.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(bins[row, feature[node]] > border[node])
            total += leaf[node - len(feature)]
        assert np.isclose(model.score(x[row:row + 1])[0], 1 / (1 + np.exp(-total)))


def test_quality_edge_rows(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (None, "text here"), (1, None), (3, "word " * 50000)])
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 1), (3, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = docs.select(quality.score(model, F.col("text")).alias("s")).collect()
    assert len(got) == 5 and all(0 <= r.s <= 1 for r in got)
    empty = quality.fit(make_docs([]), labels.limit(0))
    assert make_docs([]).select(quality.score(empty, F.col("text"))).collect() == []
    assert docs.select(quality.score(empty, F.col("text")).alias("s")).first().s == pytest.approx(0.5)


def test_language_on_held_out_documents(spark):
    got = {r.doc_id: r for r in queries.op6_language_id(spark, SMALL).collect()}
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    right = [got[d].lang_pred == x for d, x in lang.items() if held(d)]
    assert np.mean(right) > 0.97 and all(r.held_out == held(d) and 0 <= r.score <= 1 for d, r in got.items())


def test_language_edge_rows(spark, make_docs):
    en, de = "the quick brown fox jumps over the lazy dog ", "der schnelle braune fuchs springt über den faulen hund "
    rows = [(i, (en if i % 2 else de) * (1 + i % 3), "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "12 !?", "de"), (103, en * 9000, None), (None, de, "de"), (1, en, "en")]
    docs = make_docs(rows)
    model = langid.fit(docs)
    got = [(r.doc_id, r.x.lang, r.x.score) for r in
           docs.select("doc_id", langid.identify(model, F.col("text")).alias("x")).collect()]
    by = {}
    for d, lang, score in got:
        by.setdefault(d, []).append(lang)
        assert 0 <= score <= 1
    assert by[100] == by[101] == by[102] == ["und"] and by[103] == ["en"] and by[None] == ["de"] and by[1] == ["en", "en"]
    none = langid.fit(make_docs([]))
    assert {r.x.lang for r in docs.select(langid.identify(none, F.col("text")).alias("x")).collect()} == {"und"}
    assert make_docs([]).select(langid.identify(model, F.col("text"))).collect() == []


def test_all_windows_count():
    buf = np.frombuffer(b"A" * 300 + b"" + b"bc", np.uint8)
    w, text, used = langid.windows(buf, np.array([0, 300, 300, 302]))
    assert text.tolist() == [0, 0, 2] and used.tolist() == [256, 44, 2]
    assert w[0].tobytes() == b"a" * 256 and w[2, :3].tobytes() == b"bc\0"


def test_a_rare_language_is_learned_beside_large_ones(spark, make_docs):
    rnd = random.Random(4)
    words = {"en": "the quick brown fox jumps over lazy dogs with some water and bread".split(),
             "de": "der schnelle braune fuchs springt über den faulen hund mit etwas wasser".split(),
             "fi": "nopea ruskea kettu hyppää laiskan koiran yli veden ja leivän kanssa".split()}
    rows = [(i, " ".join(rnd.choice(words["en" if i % 2 else "de"]) for _ in range(30)), "en" if i % 2 else "de")
            for i in range(1500)]
    rows += [(2000 + i, " ".join(rnd.choice(words["fi"]) for _ in range(30)), "fi") for i in range(10)]
    docs = make_docs(rows)
    model = langid.fit(docs, max_train=60)
    assert model.langs == ["de", "en", "fi"]
    got = {r.doc_id: r.x.lang for r in docs.select("doc_id", langid.identify(model, F.col("text")).alias("x")).collect()}
    assert {got[d] for d in range(2000, 2010)} == {"fi"}
    assert sum(got[d] == lang for d, _, lang in rows) > 0.98 * len(rows)


def test_rows_that_repeat_an_id_reach_the_driver_once(spark, make_docs, monkeypatch):
    text = "the quick brown fox jumps over the lazy dog "
    docs = make_docs([(1, text * (1 + i % 3)) for i in range(50)] + [(i, text) for i in range(2, 12)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 12)], "doc_id long, quality int")
    sizes, plain = [], type(docs).toArrow

    def spy(self):
        sizes.append(plain(self))
        return sizes[-1]

    monkeypatch.setattr(type(docs), "toArrow", spy)
    quality.fit(docs, labels)
    langid.fit(docs)
    assert len(sizes) == 2 and all(0 < t.num_rows == len(set(t["d"].to_pylist())) for t in sizes)


def test_training_rows_are_bounded_however_many_languages(spark, make_docs, monkeypatch):
    seen = {}
    monkeypatch.setattr(langid, "fit_network", lambda w, y, langs: seen.update(n=len(w), langs=langs))
    rows = [(k, f"document {k} has a text that is long enough", f"l{k % 2000:04d}") for k in range(6000)]
    rows += [(10_000 + k, f"document {k} of a larger language, long enough", f"big{k % 3}") for k in range(90)]
    langid.fit(make_docs(rows), max_train=60)
    assert seen["langs"] == ["big0", "big1", "big2"] and seen["n"] <= 60 * langid.WINDOWS_PER_TEXT


def test_network_matches_a_naive_convolution(spark):
    """Scores of a small trained network, filter by filter and place by place."""
    rnd = np.random.default_rng(0)
    w = rnd.integers(97, 110, (40, langid.WINDOW)).astype(np.uint8)
    m = langid.fit_network(w, np.arange(40) % 2, ["a", "b"])
    got = m.log_probs(w[:5])
    for row, x in enumerate(w[:5]):
        e = m.embed[x].astype(float)
        pooled = []
        for width, f in zip(langid.WIDTHS, m.filters, strict=True):
            f = f.astype(float)
            pooled.append(np.max([[e[p:p + width].ravel() @ f[:, k] for k in range(f.shape[1])]
                                  for p in range(len(x) - width + 1)], axis=0))
        h = np.maximum(np.concatenate(pooled) + m.bias, 0)
        z = h @ m.out + m.out_bias
        assert np.allclose(got[row], z - np.log(np.exp(z - z.max()).sum()) - z.max(), atol=1e-3)
