"""Session helpers.

Every operator takes and returns DataFrames; the only session-level concern is
configuration that keeps plans healthy at scale (AQE, skew handling) and a
reliable checkpoint directory for the iterative graph operator.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning: coalesce small shuffle partitions, split skewed join
# partitions, and let AQE switch to broadcast when a side is small at runtime.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the graph iteration checkpoints one edge table per round: let Spark
    # delete checkpoints that are no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Starting point for a large cluster (hundreds of executors, ~100 TB input).
# Partition sizes are what matters: scan splits and post-shuffle partitions of
# a few hundred MB fit in executor memory, AQE coalesces small ones and splits
# skewed ones, and the initial shuffle width is high enough that no
# pre-coalesce partition is huge.
CLUSTER_CONF = {
    **RECOMMENDED_CONF,
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    # broadcast only what is provably small; larger sides use shuffled joins
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "meridian", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (the UI is kept off)."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only when unset.

    On a cluster the directory must be the shared folder named by
    ``spark.checkpoint.dir``; a machine-local temporary folder is only used
    when running in local mode (tests, bench) and nothing was configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="meridian-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; iterative operators need a shared, "
        "reliable checkpoint directory on a cluster")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the reliable checkpoint directory (set first if a
    local session has none), its lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet under the checkpoint directory and read back:
    as ``checkpointed``, in columns and compressed. Goes with the session."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/written-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
