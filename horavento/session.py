"""Session settings and the shared scratch location."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (T6), adaptive execution for
# runtime coalescing, skew splitting and size-checked broadcast conversion.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "horavento",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's settings applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in SESSION_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system every
    executor can reach), and it is an error if the session names none: a
    folder of the driver alone would lose rows.  In local mode, where driver
    and executors are one process, a private folder is created instead."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir is not set; intermediate tables need a folder that all executors share")
        root = tempfile.mkdtemp(prefix="horavento-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


_scratch: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    if _scratch:
        _scratch[-1].append(path)
    return path


def _hadoop(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch made inside is deleted on leaving, through the file system API
    of its folder.  Write or collect a result inside the scope: a DataFrame
    that still reads scratch can't be used after it."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            fs, target = _hadoop(spark, path)
            fs.delete(target, True)


def materialize(df, name: str):
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Used for intermediate tables that several branches of one plan read
    (group statistics, bucket offsets, cut tables): each is computed once
    instead of once per branch, the lineage ends there, and a lost executor
    re-reads files instead of recomputing upstream stages."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
