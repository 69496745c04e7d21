"""Session construction and the shared scratch area.

``build_session`` pins the settings the pipeline relies on (UTC session
zone, AQE with skew-join splitting, dynamic partition overwrite).
``shared_dir`` hands out fresh sub-folders of the cluster's checkpoint
folder (``spark.checkpoint.dir``); a folder of our own is only chosen when
the session has none and runs on one machine; on a cluster that is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the package assumes.
PIPELINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # keyed stream state (7 days of replay keys) lives off-heap in RocksDB
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app_name: str = "gridlake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Return a session with the pipeline settings applied.

    ``master`` is left to the launcher (spark-submit) unless given.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(PIPELINE_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    conf.setdefault("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_pipeline_conf(spark)
    return spark


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               shuffle_fraction: float = 0.3, partition_bytes: int = 256 * 2**20) -> dict[str, str]:
    """Partition sizing for a cluster run.

    The initial shuffle partition count is chosen so that one partition of
    the expected shuffle volume (``input_bytes * shuffle_fraction``) is about
    ``partition_bytes`` and fits an executor core's memory, never fewer than
    two waves of cores.  AQE then coalesces small partitions to the advisory
    size and splits skewed ones; scan splits use the same target size.
    """
    cores = executors * cores_per_executor
    wanted = int(input_bytes * shuffle_fraction // partition_bytes) + 1
    partitions = max(2 * cores, wanted)
    size = f"{partition_bytes // 2**20}m"
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * partition_bytes // 2**20}m",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def storage_conf(settings: dict[str, str]) -> dict[str, str]:
    """Object-store settings (account keys, auth type, endpoints) as
    session conf; keys are Hadoop property names, passed through as
    ``spark.hadoop.<key>``.  Paths stay plain URIs everywhere else."""
    return {k if k.startswith("spark.") else f"spark.hadoop.{k}": v for k, v in settings.items()}


def apply_pipeline_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings on an existing session."""
    for key, value in PIPELINE_CONF.items():
        spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when the session has none and its executors are this process
    (``local[..]``: ad-hoc runs, tests) is a folder of our own created and
    registered as the checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="gridlake-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/gridlake/{label}-{uuid.uuid4().hex[:12]}"


def local_fs_path(uri: str) -> str:
    """Path of a ``file:`` URI for plain file I/O in tests and fixtures."""
    return uri[len("file:"):] if uri.startswith("file:") else uri


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable (reliable, shared storage):
    the context's folder is the one named by ``spark.checkpoint.dir``."""
    try:
        sc = spark.sparkContext
    except Exception:  # remote session without a context handle: the server's conf applies
        return
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_root(spark))


__all__ = ["build_session", "apply_pipeline_conf", "storage_conf", "scale_conf", "checkpoint_root", "shared_dir",
           "ensure_checkpoint_dir", "PIPELINE_CONF"]
