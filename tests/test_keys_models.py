"""Keys of any type (B1), growing vocabularies (C1), Spark ML model directories
(A4), seen items dropped before the scores are summed (E2)."""

import pytest
from pyspark.ml.feature import MinHashLSH, MinHashLSHModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lshark.functions.minhash import fit
from lshark.operators import features, lsh, prep, recommend, topk
from lshark.session import stage_path
from lshark.sources import tables

M = fit(5, 42)


def test_keys_of_any_type(spark):
    rows = [("ann", "tea"), ("ann", "tea"), ("bob", "tea"), ("bob", "nuts"), ("ann", "nuts"), ("cy", "nuts"), ("cy", "figs"),
            (None, "tea"), ("dan", None), ("12", "x y")]
    df = spark.createDataFrame(rows, "who string, what string")
    inter, users, items = prep.keyed_interactions(df, "who", "what")
    assert {r.value: r.idx for r in users.collect()} == {"12": 0, "ann": 1, "bob": 2, "cy": 3}
    assert {r.value: r.idx for r in items.collect()} == {"figs": 0, "nuts": 1, "tea": 2, "x y": 3}
    back = prep.named(inter, u=users, i=items)
    assert back.columns == ["u", "i"]
    assert {tuple(r) for r in back.collect()} == {r for r in rows if None not in r}
    near = prep.named(topk.nearest(inter, M, 2), u=users, v=users).where("u = 'ann'").orderBy("rank").collect()
    assert (near[0].v, near[0].sim) == ("bob", 1.0)
    got = prep.named(recommend.recommend_from(topk.nearest(inter, M, 2), inter, 2), u=users, i=items)
    assert all(isinstance(r.u, str) and (r.u, r.i) not in rows for r in got.collect())


def test_dates_and_structs_are_keys(spark):
    df = spark.sql("SELECT DATE'2024-01-01' + CAST(id % 3 AS INT) AS d, named_struct('a', id % 2, 'b', 'x') AS s FROM range(12)")
    inter, users, items = prep.keyed_interactions(df, "d", "s")
    assert inter.count() == 6 and users.count() == 3 and items.count() == 2
    assert prep.named(inter, u=users, i=items).distinct().count() == 6


def test_index_grows_and_old_numbers_stay(spark):
    def frame(words):
        return spark.createDataFrame([(w,) for w in words], "w string")

    first = features.dense_index(frame(["m", "c", None, "c"]), "w")
    second = features.extend_index(first, frame(["z", "a", "c", None, "a"]), "w")
    third = features.extend_index(second, frame(["b", "m"]), "w")
    assert {r.value: r.idx for r in third.collect()} == {"c": 0, "m": 1, "a": 2, "z": 3, "b": 4}
    assert features.extend_index(second, frame([]), "w").count() == 4
    empty = features.dense_index(frame([]), "w")
    assert {r.value: r.idx for r in features.extend_index(empty, frame(["q"]), "w").collect()} == {"q": 0}


def test_model_directory_written_by_spark_ml(spark, make_inter):
    one = spark.createDataFrame([(1, Vectors.sparse(9, [1, 4, 7], [1.0] * 3))], ["id", "features"])
    ml = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=4, seed=7).fit(one)
    path = stage_path(spark, "ml")
    ml.save(path)
    model = tables.load_model(spark, path)
    assert model.coeffs == fit(4, 7).coeffs and model.num_tables == 4
    want = [int(v[0]) for v in ml.transform(one).first().hashes]
    assert lsh.signatures(make_inter({1: {1, 4, 7}}), model).first().hashes == want == model.signature([1, 4, 7])


def test_model_directory_read_by_spark_ml(spark):
    path = tables.save_ml_model(spark, M, stage_path(spark, "ml"), input_col="f")
    one = spark.createDataFrame([(1, Vectors.sparse(9, [1, 4, 7], [1.0] * 3))], ["id", "f"])
    read = MinHashLSHModel.load(path)
    assert [int(v[0]) for v in read.transform(one).first().hashes] == M.signature([1, 4, 7])
    again = tables.load_model(spark, path)
    assert again.coeffs == M.coeffs
    own = tables.save_model(spark, again, stage_path(spark, "own"))
    assert tables.load_model(spark, own) == again


def test_broken_model_directories(spark):
    with pytest.raises(FileNotFoundError, match="no model at"):
        tables.load_model(spark, stage_path(spark, "none"))
    path = stage_path(spark, "half")
    spark.createDataFrame([('{"class": "x"}',)], "value string").write.text(f"{path}/metadata")
    with pytest.raises(FileNotFoundError, match="no data/"):
        tables.load_model(spark, path)
    spark.createDataFrame([([1, 2],)], "randCoefficients array<int>").write.parquet(f"{path}/data")
    with pytest.raises(ValueError, match="holds x"):
        tables.load_model(spark, path)


@pytest.mark.parametrize("most", [512, 3, 0])
def test_seen_items_go_before_the_sum(make_inter, most):
    sets = {u: {u % 4, u % 5 + 10, u % 3 + 20} | ({50, 51} if u % 2 else set()) for u in range(1, 25)}
    inter = make_inter(sets)
    neigh = topk.nearest(inter, M, 4)
    want = {tuple(r) for r in recommend.exclude_seen(recommend.cf_scores(neigh, inter), inter).collect()}
    got = recommend.unseen_scores(neigh, inter, most=most)
    assert {tuple(r) for r in got.collect()} == want
    assert not got.join(inter, ["u", "i"]).where(F.col("score") >= 0).count()
