"""The pipeline's stages against brute force on their own input."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lshark.llm.common import stage

from llm.test_bagminhash import brute
from llm.test_substring import brute_words

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame([(90001, None, "en", "s", 0), (90002, "", "en", "s", 0), (90003, "123 456", "en", "s", 7),
                                   (90004, docs.orderBy("doc_id").first().text, "en", "s", 1)], docs.schema)
    out = [stage(docs.unionByName(extra), "test-docs")]
    for name, f in corpus_pipeline.STAGES:
        out.append(stage(f(spark, out[-1], SMALL), f"test-{name}"))
    return out


def test_stage_names_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "substrings", "packing"]
    assert all(s.dtypes == steps[0].dtypes for s in steps[1:-1])


def test_quality_keeps_good_and_drops_bad_labels(spark, steps):
    kept = {r.doc_id for r in steps[1].collect()}
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    right = [(r.doc_id in kept) == (r.quality == 1) for r in labels]
    assert sum(right) / len(right) > 0.95


def test_language_drops_texts_without_letters(steps):
    before, after = ({r.doc_id: r.text for r in s.collect()} for s in steps[1:3])
    gone = {d for d in before if d not in after}
    lettered = {d for d, t in before.items() if re.search(r"[^\W\d_]", t or "")}
    assert gone >= set(before) - lettered and len(gone & lettered) <= 0.03 * len(lettered)


def test_near_duplicates_keep_the_smallest_of_each_group(steps):
    rows = [(r.doc_id, r.text) for r in steps[2].collect()]
    assert {r.doc_id for r in steps[3].collect()} == set(brute(rows))


def test_substrings_remove_later_passages(steps):
    want = {d: (removed, kept) for d, _, removed, kept in brute_words([(r.doc_id, r.text) for r in steps[3].collect()], 20)}
    before = {r.doc_id: r for r in steps[3].collect()}
    after = {r.doc_id: r for r in steps[4].collect()}
    for d, (removed, kept) in want.items():
        if removed and not kept:
            assert d not in after
        elif removed:
            assert after[d].text == kept and after[d].n_chars == len(kept) and after[d].lang == before[d].lang
        else:
            assert after[d] == before[d]


def test_packing_holds_every_document_once(steps):
    packed = steps[5]
    assert packed.where("piece = 0").count() == steps[4].count()
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    assert fill <= 4096


def test_run_on_documents(spark):
    assert corpus_pipeline.run(spark, SMALL).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                                                         "offset"]


def test_language_keeps_documents_of_a_language_that_is_not_learned(spark):
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    en, de = "the quick brown fox jumps over the lazy dog ", "der schnelle braune fuchs springt über den faulen hund "
    rows = [(i, (en if i % 2 else de) * (1 + i % 3), "en" if i % 2 else "de", "s", 1) for i in range(800)]
    rows += [(1000 + i, "the lazy fox", "xx", "s", 1) for i in range(20)]      # too short to learn from
    rows += [(2002, en * 5, "de", "s", 1)]                                  # held out
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, spark.createDataFrame(rows, schema), SMALL).collect()}
    assert kept >= {*range(1000, 1020)} and 2002 not in kept


FILTERS = corpus_pipeline.STAGES[:-1]


@pytest.mark.parametrize("name,f", FILTERS, ids=[n for n, _ in FILTERS])
def test_stages_take_any_table(spark, name, f):
    """Empty tables, extra columns of clashing names, nulls in every column, very long texts, repeated rows."""
    base = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = base.withColumns({c: F.lit(k).cast("long") for k, c in enumerate(
        ("d", "f", "row", "kept", "n_removed", "n_words", "score", "_key_d", "found", "held_out", "spans"))})
    empty = f(spark, docs.limit(0), SMALL)
    assert empty.columns == docs.columns and empty.collect() == []
    long = " ".join(f"word{k % 977} the of and" for k in range(60_000))
    odd = [(None, None, None, None, None), (1, None, None, None, None), (70_000, long, "en", None, None), (70_001, "", None, "s", 0),
           (70_002, "the words of a text", "en", "s", 19), (70_002, "the words of a text", "en", "s", 19)]
    odd = spark.createDataFrame(odd, base.schema).withColumns({c: F.lit(5).cast("long") for c in docs.columns[5:]})
    got = f(spark, stage(docs.unionByName(odd), "odd-docs"), SMALL)
    assert got.columns == docs.columns
    rows = got.collect()
    assert {r.d for r in rows} <= {0, 5} and {r["_key_d"] for r in rows} <= {7, 5}


def test_packing_of_empty_and_odd_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("piece", F.lit("x")).withColumn("sequence_id", F.lit("y"))
    assert corpus_pipeline.packing_stage(spark, docs.limit(0), SMALL).collect() == []
    assert corpus_pipeline.packing_stage(spark, docs, SMALL).where("piece = 0").count() == docs.count()
