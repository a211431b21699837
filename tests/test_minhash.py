from pyspark.ml.feature import MinHashLSH
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from brute import signature
from lshark.functions.minhash import HASH_PRIME, JavaRandom, fit
from lshark.operators import lsh

# Spark ML's coefficients for seed 42, 5 tables, and the
# signature of {0..5} under them.
SEED42 = [(1562431131, 117392763), (1467211249, 102948884), (662969971, 2023087525),
          (595021506, 1519796918), (1429255520, 196118093)]
GOLDEN = [252893058, 428433145, 598817923, 76743681, 407735167]


def test_coefficients_seed42():
    assert list(fit(5, 42).coeffs) == SEED42


def test_java_random_matches_jvm(spark):
    jvm = spark.sparkContext._jvm
    for seed in (0, 42, -1, 2**40 + 3):
        for bound in (10, 16, 2038074742, 2**30, 7):
            ours, theirs = JavaRandom(seed), jvm.java.util.Random(seed)
            assert [ours.next_int(bound) for _ in range(20)] == [theirs.nextInt(bound) for _ in range(20)]


def test_golden_signature():
    assert signature(range(6), fit(5, 42)) == GOLDEN


def test_prefix_models_share_tables():
    assert fit(64, 7).coeffs[:5] == fit(5, 7).coeffs


def test_signature_native_equals_python(make_inter):
    m = fit(5, 42)
    sets = {1: range(6), 2: [99, 3, 12345], 3: [7]}
    got = {r.u: (r.n, list(r.hashes)) for r in lsh.signatures(make_inter(sets), m).collect()}
    for u, s in sets.items():
        assert got[u] == (len(set(s)), signature(s, m))


def test_parity_with_spark_ml(spark, make_inter):
    for seed, tables in [(42, 5), (0, 1), (-7, 3), (123456789, 8)]:
        m = fit(tables, seed)
        sets = {u: [(u * 7 + j * 13) % 50 for j in range(1 + u % 9)] for u in range(1, 30)}
        vecs = spark.createDataFrame(
            [(u, Vectors.sparse(50, sorted(set(s)), [1.0] * len(set(s)))) for u, s in sets.items()],
            ["u", "features"])
        ml = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=tables, seed=seed).fit(vecs)
        ml_sig = {r.u: [int(v[0]) for v in r.hashes] for r in ml.transform(vecs).collect()}
        ours = {r.u: list(r.hashes) for r in lsh.signatures(make_inter(sets), m).collect()}
        assert ours == ml_sig, (seed, tables)


def test_hash_range(spark):
    m = fit(5, 42)
    df = spark.range(0, 1000).select(F.col("id").alias("i"))
    mx = df.select(F.max(m.hash_col(F.col("i"), 0))).first()[0]
    assert 0 <= mx < HASH_PRIME
