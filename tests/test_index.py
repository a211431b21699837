import random

import pytest

from lshark.functions.minhash import fit
from lshark.operators import index, lsh
from lshark.session import checkpoint_dir, stage_path, stage_scope

M = fit(5, 42)


def sets(seed, n=60):
    rnd = random.Random(seed)
    base = [set(rnd.sample(range(80), rnd.randint(3, 25))) for _ in range(9)]
    return {u: base[u % 9] ^ set(rnd.sample(range(80), rnd.randint(0, 4))) for u in range(n)}


def rows(df):
    return [(r.v, pytest.approx(r.sim), r["rank"]) for r in df.orderBy("rank").collect()]


@pytest.mark.parametrize("ride", [1024, 12, 0])
def test_probe_equals_the_search_over_the_table(spark, make_inter, monkeypatch, ride):
    monkeypatch.setattr(index, "RIDE", ride)
    data = sets(ride)
    inter = make_inter(data)
    path = stage_path(spark, "index")
    index.write_index(inter, M, path, ranges=4, parts=3)
    opened = index.open_index(spark, path)
    assert opened.model == M
    for key in (0, 7, 31):
        want = rows(lsh.neighbors(inter, M, key, 8))
        assert rows(index.neighbors(spark, opened, key, 8)) == want
        if ride >= len(data[key]):
            assert rows(index.neighbors_of(spark, opened, data[key], 8)) == want
    assert index.neighbors(spark, opened, 12345, 8).collect() == []
    with pytest.raises(ValueError):
        index.neighbors_of(spark, opened, [], 8)


def test_a_probe_reads_one_folder_per_table(spark, make_inter):
    path = stage_path(spark, "index")
    opened = index.write_index(make_inter(sets(3)), M, path, ranges=16)
    read = index.bucket_rows(spark, opened, M.signature([1, 2, 3]))
    files = {f.split("/tb=")[1].rsplit("/", 1)[0] for f in index.bucket_rows(spark, opened, M.signature([1, 2, 3])).inputFiles()}
    assert "PartitionFilters: [((" in read._jdf.queryExecution().executedPlan().toString()
    scan = read._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.selectedPartitions().partitionCount() <= 5 < len(files)


def test_folders_go_with_the_scope(spark, make_inter):
    hadoop, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    with stage_scope(spark):
        path = stage_path(spark, "index")
        index.write_index(make_inter({1: {1, 2}}), M, path)
        p = jvm.org.apache.hadoop.fs.Path(path)
        assert path.startswith(checkpoint_dir(spark)) and p.getFileSystem(hadoop).exists(p)
    assert not p.getFileSystem(hadoop).exists(p)
