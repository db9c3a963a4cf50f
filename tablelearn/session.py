"""Session helpers: a local session for tests and the bench, and shared scratch paths.

On a cluster the caller builds the session; the library only reads
``spark.checkpoint.dir`` (a folder every executor can reach) and never falls
back to a machine-local folder there. Only a local session without that
setting (tests, bench) gets a fresh folder under the system temp dir.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tablelearn") -> SparkSession:
    """A local session with the settings the tests and the bench assume."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    The setting is read from the session (cluster conf). Only when it is unset
    and the session is local is a fresh temp folder chosen, as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a folder all executors share"
        )
    folder = tempfile.mkdtemp(prefix="tablelearn-ckpt-")
    sc.setCheckpointDir(folder)
    spark.conf.set(CHECKPOINT_CONF, folder)
    return sc.getCheckpointDir() or folder


def scratch_root(spark: SparkSession) -> str:
    """The one folder (under this context's checkpoint folder) that holds every
    intermediate table the library writes; remove it with the cluster's own tools
    once the session's results are saved. The library itself deletes nothing."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tablelearn-scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under ``scratch_root``."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def default_parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.sparkContext.defaultParallelism))


def materialize(df, name: str):
    """Write ``df`` once to the shared checkpoint folder and read it back (cuts lineage;
    later jobs and a lost executor read files instead of recomputing the plan)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
