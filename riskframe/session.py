"""SparkSession construction and cluster-shared storage helpers."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",   # with the table that used them
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "riskframe", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and skew-join handling.

    On a cluster, ``master`` is left to spark-submit and the shuffle partition
    count to the cluster config; tests pass ``local[*]`` and a small count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, as named by ``spark.checkpoint.dir``.

    A cluster names it; only a local session without one (tests, bench) gets a
    fresh scratch folder, which is then recorded in the session.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):     # local-cluster is a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="riskframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df):
    """Reliable checkpoint into the shared folder named by
    ``spark.checkpoint.dir``: a lost executor costs a re-read, not a
    recomputation of the lineage.  The plan is persisted first so the
    checkpoint write does not compute it a second time (measured faster here
    than writing and re-reading a Parquet table; ``materialize`` does that)."""
    from pyspark import StorageLevel
    shared_dir(df.sparkSession)
    p = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = p.checkpoint(eager=True)
    p.unpersist()
    return out


_WRITTEN: list = []


def materialize(df, name: str = "tables"):
    """Write ``df`` as a Parquet table in the shared folder and read it back
    (column pruning and pushdown on later reads).  The table is removed when
    the driver ends."""
    spark = df.sparkSession
    path = scratch_path(spark, os.path.join(name, uuid.uuid4().hex))
    df.write.mode("overwrite").parquet(path)
    if not _WRITTEN:
        atexit.register(drop_materialized)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_materialized() -> None:
    """Remove the tables that ``materialize`` wrote."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        if spark.sparkContext._jsc is not None:
            file_system(spark, path).delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)


def file_system(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def snapshot(spark: SparkSession, *paths: str) -> tuple:
    """(file, bytes, modification time) of the files at ``paths``: the identity
    of an input, so that a result kept for it is not used after it changed."""
    out = []
    for path in paths:
        for s in file_system(spark, path).listStatus(spark._jvm.org.apache.hadoop.fs.Path(path)):
            out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return tuple(sorted(out))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder for intermediate tables."""
    base = shared_dir(spark)
    return os.path.join(base, name)
