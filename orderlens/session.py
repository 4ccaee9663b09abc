"""Session helpers: time-zone pinning and a reliable folder for lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

UTC = "UTC"


def pin_utc(spark: SparkSession) -> SparkSession:
    """All instants in this library are UTC; formatting and parsing of zone-less text follow
    the session zone, so it is pinned once per entry point."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "orderlens") -> SparkSession:
    """Session for tests and the local bench (never used by library code)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small local inputs: keep post-shuffle stages wide enough for row-heavy work
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ORDERLENS_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local-mode session (tests, the local bench) that names none gets a scratch folder; on
    a cluster a machine-local folder would not survive an executor loss, so one is required."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage).")
    folder = tempfile.mkdtemp(prefix="orderlens-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for a written intermediate table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


#: Folders of stages that have not been dropped, in the order in which they were made.
_STAGES: list[str] = []


def file_system(spark: SparkSession, path: str):
    """The store that holds ``path``, and the path as it knows it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def keep_stage(spark: SparkSession, path: str) -> None:
    """Enter ``path``, where an intermediate table goes, as one that leaves with this application: the
    store deletes it when the driver ends, unless it is dropped before."""
    fs, at = file_system(spark, path)
    fs.deleteOnExit(at)
    _STAGES.append(path)


def _drop(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)
    fs.cancelDeleteOnExit(at)
    if path in _STAGES:
        _STAGES.remove(path)


def written_stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back.

    Every reader sees the same rows, a lost executor costs nothing, and the folder is new each
    time, so a later run over grown or rewritten inputs never meets an older result. It lasts until
    :func:`drop_stage`, the end of a :func:`scratch` block, or the end of the driver."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    keep_stage(spark, path)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.stage_path = path
    return staged


def drop_stage(staged: DataFrame) -> None:
    """Delete a written stage, given as :func:`written_stage` returned it, once its last reader has run."""
    _drop(staged.sparkSession, staged.stage_path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Stages written inside the block are deleted at its end: write or collect the result inside."""
    before = set(_STAGES)
    try:
        yield
    finally:
        for path in [p for p in _STAGES if p not in before]:
            _drop(spark, path)
