"""Session helpers: building a local session and finding the shared scratch folder.

Library code never sets cluster-wide configuration. The one thing it needs
from the session is a folder every executor can reach, which is the folder
the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "quillrank") -> SparkSession:
    """A local session for tests, the bench and the smoke entry."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A join whose every partition was measured small is hashed instead of sorted.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where it is unset.

    On a cluster the folder must come from the cluster's configuration; a
    machine-local temporary folder is only acceptable for a local session.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; iterative operators need a folder "
                "that every executor can reach (e.g. an HDFS or object-store path)"
            )
        configured = tempfile.mkdtemp(prefix="quillrank-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete one intermediate folder through the Hadoop file system it is in."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/quillrank-{label}-{uuid.uuid4().hex[:12]}"
