import hashlib
import os

import pytest

from conftest import SF_SMALL
from pyspark.sql import functions as F

from lshark import session
from lshark.functions.minhash import fit
from lshark.operators import lsh, prep
from lshark.session import checkpoint_dir, clear_stages, cut_lineage
from lshark.plans import catalog
from lshark.sources import tables


def test_load_uses_declared_schema(spark):
    ev = tables.load(spark, SF_SMALL, "events")
    assert ev.schema == tables.SCHEMAS["events"]
    assert ev.count() > 0


def test_preprocessed_roundtrip(spark, make_inter):
    inter = make_inter({1: {1, 2}, 2: {3}})
    path = os.path.join(checkpoint_dir(spark), "test-pre")
    tables.write_preprocessed(inter, path)
    back = tables.read_preprocessed(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, inter.collect()))


def test_model_roundtrip(spark, make_inter):
    m = fit(7, 99)
    path = os.path.join(checkpoint_dir(spark), "test-model")
    tables.save_model(spark, m, path)
    m2 = tables.load_model(spark, path)
    assert m2 == m
    inter = make_inter({1: {1, 2, 3}, 2: {4}})
    a = {r.u: list(r.hashes) for r in lsh.signatures(inter, m).collect()}
    b = {r.u: list(r.hashes) for r in lsh.signatures(inter, m2).collect()}
    assert a == b


def test_subset_is_deterministic_md5_filter(spark):
    part = tables.load(spark, SF_SMALL, "part")
    got = {r.p_partkey for r in prep.subset(part, "p_partkey", 0.25).collect()}
    want = {k for (k,) in part.select("p_partkey").collect()
            if hashlib.md5(str(k).encode()).hexdigest()[:2] < "40"}
    assert got == want and 0 < len(got) < part.count()
    assert prep.subset(part, "p_partkey", 1.0).count() == part.count()


def test_cut_lineage_same_rows(spark, make_inter):
    inter = make_inter({1: {1, 2}, 2: {3}})
    assert sorted(map(tuple, cut_lineage(inter).collect())) == sorted(map(tuple, inter.collect()))
    assert clear_stages(spark) >= 1
    assert clear_stages(spark) == 0


def test_spread_only_when_needed(spark):
    df = spark.range(0, 100, numPartitions=1)
    assert tables.spread(df, 4).rdd.getNumPartitions() == 4
    many = spark.range(0, 100, numPartitions=6)
    assert tables.spread(many, 4).rdd.getNumPartitions() == 6


def test_to_ml_model_hashes_like_ours(spark, make_inter):
    from pyspark.ml.linalg import Vectors
    m = fit(5, 42)
    ml = tables.to_ml_model(spark, m)
    vec = spark.createDataFrame([(1, Vectors.sparse(10, [0, 3, 7], [1.0, 2.0, 5.0]))], ["u", "features"])
    got = [int(v[0]) for v in ml.transform(vec).first().hashes]
    ours = list(lsh.signatures(make_inter({1: {0, 3, 7}}), m).first().hashes)
    assert got == ours


def test_subset_meets_small_fractions(spark):
    df = spark.range(200_000).withColumnRenamed("id", "k").unionByName(spark.createDataFrame([(None,)], "k bigint"))
    for fraction in (0.0, 0.001, 0.0019, 0.01, 0.3, 1.0):
        n = prep.subset(df, "k", fraction).count()
        assert abs(n - 200_000 * fraction) <= 5 * (200_000 * fraction * (1 - fraction)) ** 0.5
    small = {r.k for r in prep.subset(df, "k", 0.001).collect()}
    assert small <= {r.k for r in prep.subset(df, "k", 0.01).collect()}


def test_checkpoint_folder_is_never_local_on_a_cluster():
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session._local_folder(master)
    assert session._local_folder("local[2]")


def test_a_scope_leaves_no_stage_table(spark):
    kept = cut_lineage(spark.range(3), "outer")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(session.checkpoint_dir(spark))
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before = {str(f.getPath()) for f in files.listStatus(folder)}
    with session.stage_scope(spark):
        rows = catalog.queries()["document_near_copies"](spark, SF_SMALL).count()
        assert {str(f.getPath()) for f in files.listStatus(folder)} > before
    assert {str(f.getPath()) for f in files.listStatus(folder)} == before
    assert rows > 0 and kept.count() == 3


def test_written_stage_leaves_no_shuffle_files(spark):
    """Shuffle files of a stage go with its write, and the session's own setting stays."""
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    a = spark.range(3000).select("id", (F.col("id") % 100).alias("k"))
    sums = a.groupBy("k").agg(F.sum("id").alias("n"))
    before, setting = tracker.shuffleStatuses().size(), spark.conf.get(session.SHUFFLES_GO, None)
    written = session.cut_lineage(a.repartition(3, "k").join(sums, "k"), "t")
    assert tracker.shuffleStatuses().size() <= before
    assert spark.conf.get(session.SHUFFLES_GO, None) == setting
    assert written.count() == 3000 and written.agg(F.sum("n")).first()[0] == 30 * sums.agg(F.sum("n")).first()[0]
