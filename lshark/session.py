"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Session settings the library relies on; callers on a cluster keep their own
# master, memory and partition counts and only need AQE left on.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "lshark", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per Spark context, so Python
    tasks can import it wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_lshark_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="lshark-src-"), "lshark_src.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("lshark", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._lshark_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by whoever runs the job and must be a shared
    file system.  Only a session whose executors are threads of the driver
    (master ``local`` or ``local[...]``) gets a temporary folder when it is
    unset; elsewhere that folder would be on one machine, so this raises.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if path:
        return path
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = _local_folder(sc.master)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def _local_folder(master: str) -> str:
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    return tempfile.mkdtemp(prefix="lshark-ckpt-")


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and
    read it back.

    The result no longer depends on the upstream plan, so losing an executor
    later only re-reads files instead of recomputing from the source; the
    columnar copy also gives the optimizer exact sizes for the next joins.
    (``Dataset.checkpoint`` would recompute the plan and Java-serialise rows.)
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    with _own_shuffles(spark):
        df.write.parquet(path)
    return spark.read.parquet(path)


@contextmanager
def _own_shuffles(spark: SparkSession) -> Iterator[None]:
    """A table written inside takes its shuffle files along when it is done;
    else they lie on the disks until the driver happens to collect its garbage.
    A write plans its query anew, so no other query reads them."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder that goes with the innermost open scope."""
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _SCOPES.get()[-1].append(path)
    return path


#: Paths of stage tables, one list per open scope of this thread of control.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("lshark_stages", default=([],))


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, on leaving, the stage tables written inside: wrap a query *and*
    the action that consumes it.  Tables of other scopes stay."""
    token = _SCOPES.set((*_SCOPES.get(), []))
    try:
        yield
    finally:
        clear_stages(spark)
        _SCOPES.reset(token)


def clear_stages(spark: SparkSession) -> int:
    """Delete the stage tables of the innermost open scope and return their
    number.  Call once the DataFrames built on them have been consumed;
    deletion goes through the Hadoop file system of the checkpoint folder."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    stages, removed = _SCOPES.get()[-1], 0
    while stages:
        p = jvm.org.apache.hadoop.fs.Path(stages.pop())
        if p.getFileSystem(conf).delete(p, True):
            removed += 1
    return removed
