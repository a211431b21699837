"""Sources and sinks: explicit-schema table reads (A1), the preprocessed
table (A3) and the fitted model (A4)."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lshark.functions.minhash import MinHashModel

_L, _I, _D, _S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
_TS = T.TimestampNTZType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Declared schemas of the input tables; reads never infer.
SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I),
                        ("c_acctbal", _D), ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S),
                    ("p_size", _I), ("p_retailprice", _D)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
                      ("o_totalprice", _D), ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                        ("l_linenumber", _I), ("l_quantity", _D), ("l_extendedprice", _D),
                        ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
                        ("l_linestatus", _S), ("l_shipdate", _TS)),
    "events": _schema(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S),
                      ("value", _D), ("props", _S)),
    "documents": _schema(("doc_id", _L), ("text", _S), ("lang", _S), ("source", _S),
                         ("n_chars", _L)),
    "labels": _schema(("doc_id", _L), ("quality", _I), ("toxic", _I)),
    "benchmark": _schema(("item_id", _L), ("text", _S)),
    "pages": _schema(("page_id", _L), ("url", _S), ("html", _S)),
    "conversations": _schema(("conv_id", _L), ("turn", _L), ("role", _S), ("text", _S)),
    "embeddings": _schema(("vec_id", _L), ("embedding", T.ArrayType(T.FloatType())), ("label", _I)),
}


def table_path(spark: SparkSession, base: str, name: str) -> str:
    """``<base>/<name>.parquet`` if it is there, else ``<base>/<name>``; looked
    up through Spark's file systems, as executors will read it."""
    single = f"{base.rstrip('/')}/{name}.parquet"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(single)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return single if there else f"{base.rstrip('/')}/{name}"


def load(spark: SparkSession, base: str, name: str, fmt: str = "parquet",
         schema: T.StructType | None = None, **options) -> DataFrame:
    """Read ``name`` under ``base`` with its declared schema (A1).

    Parquet is the default; ``fmt='csv'`` / ``'json'`` go through the same
    path with the same schema, so nothing is inferred on either route.
    """
    schema = schema or SCHEMAS.get(name)
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(table_path(spark, base, name) if fmt == "parquet" else
                                   f"{base.rstrip('/')}/{name}")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over the cluster when its scan has fewer partitions
    than the default parallelism (e.g. one large row group).  Used before
    CPU-heavy per-row work such as tokenising; on a many-file scan it is a
    no-op, so it never adds a shuffle where the input is already split."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def write_preprocessed(df: DataFrame, path: str, partition_by: list[str] | None = None,
                       mode: str = "overwrite") -> str:
    """Write a preprocessed table as parquet (A3)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_preprocessed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


MODEL_SCHEMA = T.StructType([
    T.StructField("num_tables", T.IntegerType(), False),
    T.StructField("seed", T.LongType(), True),
    T.StructField("coeffs", T.ArrayType(T.StructType([
        T.StructField("a", T.LongType(), False), T.StructField("b", T.LongType(), False)])), False),
])


def save_model(spark: SparkSession, model: MinHashModel, path: str) -> str:
    """Persist a model as one parquet row: parameters, seed and coefficients (A4)."""
    row = [(model.num_tables, model.seed, [(a, b) for a, b in model.coeffs])]
    spark.createDataFrame(row, MODEL_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load_model(spark: SparkSession, path: str) -> MinHashModel:
    """Read a saved model back, from our own format or from a Spark ML model
    directory; the row is tiny (num_tables pairs)."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"there is no model at {path}")
    if _exists(spark, f"{path}/metadata"):
        return load_ml_model(spark, path)
    rows = spark.read.schema(MODEL_SCHEMA).parquet(path).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one model row at {path}, found {len(rows)}")
    r = rows[0]
    coeffs = tuple((int(c["a"]), int(c["b"])) for c in r["coeffs"])
    if len(coeffs) != r["num_tables"]:
        raise ValueError("model row is inconsistent: coefficient count != num_tables")
    return MinHashModel(int(r["num_tables"]), r["seed"], coeffs)


#: Fixed value: the class that Spark ML names in a model directory.
ML_CLASS = "org.apache.spark.ml.feature.MinHashLSHModel"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def save_ml_model(spark: SparkSession, model: MinHashModel, path: str, input_col: str = "features",
                  output_col: str = "hashes") -> str:
    """Write ``model`` as a Spark ML model directory (A4): one line of JSON under
    ``metadata``, one row of coefficients under ``data``.
    ``MinHashLSHModel.load`` reads it."""
    uid = f"MinHashLSH_{uuid.uuid4().hex[:12]}"
    meta = {"class": ML_CLASS, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
            "paramMap": {"inputCol": input_col, "outputCol": output_col, "numHashTables": model.num_tables},
            "defaultParamMap": {"numHashTables": 1, "outputCol": f"{uid}__output"}}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
    flat = [x for pair in model.coeffs for x in pair]
    spark.createDataFrame([(flat,)], "randCoefficients array<int>").coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    return path


def load_ml_model(spark: SparkSession, path: str) -> MinHashModel:
    """Read a model directory as Spark ML writes it.  Such a directory keeps the
    coefficients, not the seed they came from."""
    for part in ("metadata", "data"):
        if not _exists(spark, f"{path}/{part}"):
            raise FileNotFoundError(f"{path} is no complete model directory: it has no {part}/")
    lines = [r["value"] for r in spark.read.text(f"{path}/metadata").limit(2).collect()]
    meta = json.loads(lines[0]) if len(lines) == 1 else {}
    if meta.get("class") != ML_CLASS:
        raise ValueError(f"{path} holds {meta.get('class') or 'no readable metadata'}, not {ML_CLASS}")
    rows = spark.read.schema("randCoefficients array<int>").parquet(f"{path}/data").limit(2).collect()
    flat = rows[0]["randCoefficients"] if len(rows) == 1 else None
    params = meta.get("defaultParamMap", {}) | meta.get("paramMap", {})
    tables = int(params.get("numHashTables", 1))
    if not flat or len(flat) != 2 * tables:
        raise ValueError(f"{path} is inconsistent: {len(flat or [])} coefficients for {tables} hash tables")
    return MinHashModel(tables, params.get("seed"), tuple(zip(flat[::2], flat[1::2], strict=True)))


def to_ml_model(spark: SparkSession, model: MinHashModel, input_col: str = "features",
                output_col: str = "hashes"):
    """The equivalent ``pyspark.ml`` model (parity checks, ML pipelines).

    The ML estimator draws the same coefficients from the same seed; fitting
    needs one vector only to learn the input dimension, so a one-row frame is
    enough (no pass over any table).
    """
    from pyspark.ml.feature import MinHashLSH
    from pyspark.ml.linalg import Vectors, VectorUDT

    one = spark.createDataFrame([(Vectors.sparse(1, [0], [1.0]),)],
                                T.StructType([T.StructField(input_col, VectorUDT())]))
    return MinHashLSH(inputCol=input_col, outputCol=output_col,
                      numHashTables=model.num_tables, seed=model.seed).fit(one)


__all__ = ["SCHEMAS", "load", "spread", "write_preprocessed", "read_preprocessed", "save_model",
           "load_model", "save_ml_model", "load_ml_model", "to_ml_model"]
