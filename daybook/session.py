"""Session construction and the shared checkpoint / scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every daybook session wants.  AQE re-plans joins from runtime sizes
# (turns a shuffle join into a broadcast only when the measured side is small)
# and splits skewed shuffle partitions.  Date keys are computed from
# zone-less timestamps, but UTC keeps any zoned input unambiguous.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Tables that are built at the same time share the cluster (plans.build.run_graph).
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Starting shuffle settings for a job reading about ``input_bytes``.

    Start with enough shuffle partitions that the largest shuffle (at most
    about the input size) splits into ``target_partition_bytes`` pieces, and
    at least two waves of the cluster's cores; AQE then coalesces small
    partitions to the advisory size and splits skewed ones.  Scans split
    files at 256 MB.
    """
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
    }


def get_session(
    master: str | None = None,
    app_name: str = "daybook",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session with the daybook defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder used for checkpoints and written intermediates.

    The cluster names it in ``spark.checkpoint.dir``; that setting always
    wins.  Only a local-mode session without the setting (tests, a laptop)
    gets a fresh folder of its own.  A cluster without it is an error: a
    machine-local folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no local SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS, object store) before running daybook on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="daybook-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "daybook-scratch", f"{name}-{uuid.uuid4().hex}")
