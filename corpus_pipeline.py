"""Corpus pipeline over ``documents``: quality, language, near copies, repeated
passages, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame.  ``run``
writes each stage's result as Parquet in the shared checkpoint folder and
reads it again as the next stage's input.  All stages but the last return the
columns of ``documents``; rows a stage keeps keep their values, except that
the fourth replaces ``text`` and ``n_chars`` where it removes words.  Further
columns pass through whatever their names.  Every stage returns an empty table
for an empty one and reads texts whole, however long.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lshark.llm import bagminhash, langid, packing, quality, substring
from lshark.llm.common import stage
from lshark.llm.queries import GOOD, WORD_BPE

#: From this probability on, a language other than the declared one counts as certain.
CERTAIN = 0.9


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores as good.  It learns from the
    labels of documents that are not held out.  A null text is scored as an
    empty one; rows that repeat a document have its score."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality.score(model, F.col("text")) >= GOOD)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a letter go, and those whose
    text is certainly in another language than their ``lang`` says.  Where the
    model has not learned ``lang``, or ``lang`` is null, it cannot tell, and the
    document stays.  Null and empty texts have no letter."""
    model = langid.fit(docs)
    found = langid.identify(model, F.col("text"))
    other = F.col("lang").isin(model.langs) & (found["lang"] != F.col("lang")) & (found["score"] >= CERTAIN)
    return docs.where((found["lang"] != langid.UNKNOWN) & ~F.coalesce(other, F.lit(False)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id (null
    ids before all others).  Of rows that repeat both id and text one stays;
    texts without words are in no group."""
    return bagminhash.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also start earlier in the corpus; a
    document that loses all its words goes.  Null texts and texts without words
    stay as they are; rows that repeat both id and text are one place and lose
    the same words."""
    cut = substring.remove_repeats(docs, carry=True).where("n_removed < n_words or n_words = 0")
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("kept")).otherwise(F.col("row.text")),
           "n_chars": F.when(changed, F.length("kept")).otherwise(F.col("row.n_chars"))}
    return cut.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(f"row.`{c}`").alias(c)
                        for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents with their place in a sequence.  A
    null text is packed as an empty one, and every row for itself."""
    return packing.pack_documents(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("packing", packing_stage),
]

#: Trained models, signatures and the tokenizer are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, f in STAGES:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
