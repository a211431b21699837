"""Registered queries of the thirteen operators: each takes ``(spark, sf_dir)``,
applies one operator with production parameters to its whole table and
returns the digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lshark.llm import (
    bagminhash,
    bytebpe,
    fmindex,
    langid,
    mtree,
    packing,
    pigeonhole,
    quality,
    spelling,
    substring,
    suffix,
    warc,
    whitening,
)
from lshark.llm.oracle import ORACLE
from lshark.sources.tables import spread

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A whole table; dealt out if it comes in fewer pieces than there are cores."""
    return spread(spark.read.parquet(f"{base}/{name}.parquet"))


#: Score from which a document counts as good, as the contract of operator 1 sets it.
GOOD = 0.3


def op1_quality_classifier(spark, base):
    docs = table(spark, base, "documents")
    model = quality.fit(docs, table(spark, base, "labels"))
    scored = docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"),
                         quality.score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


def op2_best_fit_packing(spark, base):
    return packing.pack_documents(table(spark, base, "documents"), public_tokenizers.path(WORD_BPE))


def op3_byte_bpe(spark, base):
    return bytebpe.round_trip(table(spark, base, "documents"), public_tokenizers.path(BYTE_BPE),
                              public_tokenizers.PATTERN)


def op4_minhash_dedup(spark, base):
    return bagminhash.near_duplicates(table(spark, base, "documents"))


def op5_topk_search(spark, base):
    return mtree.top_k(table(spark, base, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_language_id(spark, base):
    docs = table(spark, base, "documents")
    model = langid.fit(docs)
    found = docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"),
                        langid.identify(model, F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def op7_warc(spark, base):
    return warc.archive_pages(table(spark, base, "pages"))


def op8_substring_dedup(spark, base):
    return substring.digest(substring.remove_repeats(table(spark, base, "documents")))


def op9_embedding_dedup(spark, base):
    return pigeonhole.near_duplicates(table(spark, base, "embeddings"))


def op10_suffix_dedup(spark, base):
    return suffix.digest(suffix.remove_repeats(table(spark, base, "documents")))


def op11_spelling_variants(spark, base):
    return spelling.variants(table(spark, base, "documents"))


def op12_decontamination(spark, base):
    return fmindex.digest(fmindex.decontaminate(table(spark, base, "documents"), table(spark, base, "benchmark")))


def op13_embedding_whitening(spark, base):
    return whitening.digest(whitening.whiten(table(spark, base, "embeddings")))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_minhash_dedup": op4_minhash_dedup,
    "op5_topk_search": op5_topk_search,
    "op6_language_id": op6_language_id,
    "op7_warc": op7_warc,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_decontamination": op12_decontamination,
    "op13_embedding_whitening": op13_embedding_whitening,
}


def queries():
    return dict(QUERIES)


def oracle():
    """DuckDB twins of the queries that SQL can express."""
    return {k: f() for k, f in ORACLE.items()}
