"""Session helpers: build a local session for tests/bench, and resolve the
shared checkpoint folder that lineage cuts write to."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "smogline") -> SparkSession:
    """Local session used by tests and the bench (never by library code)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read.
    A fresh local folder is made solely when the session runs in local mode
    and nothing is configured (tests, bench).
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is unset; point it at a shared folder on the cluster")
    path = tempfile.mkdtemp(prefix="smogline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set(CHECKPOINT_CONF, path)
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{name}"


def pin_table(df, name: str):
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    read it back: a lineage cut that survives executor loss and keeps columnar
    reads (pruning, pushdown) for every later consumer."""
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
