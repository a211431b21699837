import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    # names that operators use inside
    T.StructField("d", T.StringType()), T.StructField("f", T.LongType()), T.StructField("h", T.LongType()),
    T.StructField("row", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("spans", T.StringType()),
])


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from ``(doc_id, text[, lang])`` rows, with extra columns whose names clash."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "x", 1, 2, "r", 3, "s") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
