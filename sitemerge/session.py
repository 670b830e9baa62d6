"""Session helpers: a local session for tests and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks (no UI, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sitemerge")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # max(id) on a published state then reads parquet footers only
        .config("spark.sql.parquet.aggregatePushdown", "true")
        .config("spark.driver.memory", os.environ.get("SITEMERGE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised intermediates.

    The folder the cluster names in ``spark.checkpoint.dir`` is used when set.
    Only a local session without that setting (tests) gets a folder of its
    own; on a cluster a machine-local folder would lose data with the
    executor, so there it is an error."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext
        sc = None
    if sc is None:
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="sitemerge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def session_key(spark: SparkSession) -> str:
    """An id of the running application (to cache per session)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def drop_shuffles(spark: SparkSession) -> None:
    """Have a query's shuffle files removed when the query ends.  Otherwise they stay until
    the driver collects its garbage, which a driver with free memory rarely does, and runs
    of many queries fill the executors' disks.  A session that sets it keeps its choice."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, "true")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet under the checkpoint folder and return a
    DataFrame reading it back.

    This cuts the lineage like ``checkpoint()`` but in one job (an eager
    reliable checkpoint computes its input a second time to write it) and in
    a columnar, compressed form; each call writes a new folder, so no job
    overwrites files it reads."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/sitemerge/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
