"""Session helpers.

The library never creates a cluster session by itself: callers pass a
``SparkSession``. ``local_session`` is for tests, benches and the CLI on one
machine. ``ensure_checkpoint_dir`` reads ``spark.checkpoint.dir`` from the
session and only invents a local folder when the session runs in local mode
and the setting is absent.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this engine wants; AQE re-plans shuffles at run
# time (coalesces small partitions, splits skewed join partitions).
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove reliable-checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "riskframe", extra: dict | None = None) -> SparkSession:
    """A single-machine session for tests and benches (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**ENGINE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it from the session.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; we only
    fall back to a fresh local temp folder when running ``local[...]``.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master != "local" and not sc.master.startswith("local["):    # local-cluster is a cluster
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder for this cluster")
    path = tempfile.mkdtemp(prefix="riskframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for intermediate tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate data from whatever store holds it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20
                     ) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of (compressed) input.

    * scan splits of ``target_partition_bytes`` (fewer, larger tasks than the
      128 MB default for very large inputs);
    * initial shuffle partitions sized so each holds ~``target_partition_bytes``
      of the largest shuffle (assumed no larger than the input), at least
      2 x cores; AQE then coalesces small ones and splits skewed ones;
    * skew handling on for joins and for rebalancing.
    The checkpoint folder is not set here: it must name a shared folder of
    the cluster (``spark.checkpoint.dir``).
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        **ENGINE_CONF,
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(8 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
