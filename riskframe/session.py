"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every riskframe job relies on. AQE re-plans joins from runtime sizes,
# coalesces tiny shuffle partitions and splits skewed ones; the session time zone
# is pinned so timestamp_ntz arithmetic is the same on every executor.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Sizing for a large input: scan splits and initial shuffle partitions of ~256 MB, never fewer than
    2x the cores; AQE then coalesces small partitions (advisory 128 MB) and splits skewed ones."""
    shuffle = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def build_session(master: str | None = None, app: str = "riskframe",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with riskframe's defaults.

    On a cluster ``master`` is left to spark-submit; in tests pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode runs every task in the driver JVM; only effective when this call starts the JVM
        conf.setdefault("spark.driver.memory", "8g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    (local tests) is a private scratch folder created and registered with the
    SparkContext (the conf itself cannot be changed at runtime). On any other
    master a missing setting is an error: a machine-local folder would be lost.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    ctx_dir = spark.sparkContext.getCheckpointDir()
    if d:
        if not ctx_dir:
            spark.sparkContext.setCheckpointDir(d)
        return d
    if ctx_dir:
        return ctx_dir
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("on a cluster spark.checkpoint.dir must name a folder that driver and executors share")
    d = tempfile.mkdtemp(prefix="riskframe-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def spread(df):
    """The rows, written once, in as many parts as there are cores where they lay in fewer: a small table that was put into
    one part would be fitted by one task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    held = cut_lineage(df)
    return held if held.rdd.getNumPartitions() >= cores else cut_lineage(held.repartition(cores))


def local_path(p: str) -> str:
    return p if "://" in p else os.path.abspath(p)
