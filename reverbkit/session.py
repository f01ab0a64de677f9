"""SparkSession helpers.

``get_spark`` is for local runs and tests only; on a cluster the caller's
session is used as is. ``checkpoint_dir`` reads ``spark.checkpoint.dir``
from the session; where it is unset, a scratch folder serves on a ``local``
master only, and any other master is an error: executors on other machines
could not read it.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
}


def cluster_conf(shuffle_bytes: float, target_partition_bytes: int = 200 << 20,
                 scan_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster, sized from the expected shuffle volume.

    * initial shuffle partitions = shuffle bytes / ~200 MB, so no reducer
      task has to spill far beyond its memory; AQE coalesces small ones;
    * scan splits of 256 MB keep task counts manageable on 100 TB inputs;
    * AQE skew handling splits partitions > 5x the median and > 256 MB;
    * broadcasts stay capped (Spark checks the size before broadcasting).
    ``spark.checkpoint.dir`` must point at shared storage; it is not set here.
    """
    parts = max(200, int(shuffle_bytes // target_partition_bytes) + 1)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(scan_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "5000",
        "spark.ui.enabled": "false",
    }


def get_spark(master: str | None = None, app: str = "reverbkit", conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master or os.environ.get("REVERBKIT_MASTER", "local[8]")).appName(app)
    for k, v in {**LOCAL_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a scratch folder on a local master."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        if sc is None or not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        # one machine (local runs, tests)
        d = tempfile.mkdtemp(prefix="reverbkit-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, name: str = "t") -> DataFrame:
    """Materialises ``df`` once as a parquet table in the shared checkpoint
    folder and returns a reader over it.

    Survives executor loss (files live in shared storage), computes the input
    once (a reliable RDD checkpoint would run it twice unless cached), and
    later readers get column pruning and filter pushdown.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
