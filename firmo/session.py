"""Session helpers: sane defaults and a shared scratch location.

Scratch data (lineage cuts, landed test files) goes under the folder named by
``spark.checkpoint.dir``; on a cluster that is shared storage.  Only when the
setting is absent (local tests) do we pick a folder of our own.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "firmo", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Read from the session; set our own only where it is unset (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        # a folder of our own is seen by all only where there is one machine
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="firmo-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001  (core confs may be read-only at runtime)
            pass
    sc_dir = spark.sparkContext.getCheckpointDir()
    if not sc_dir:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_watched: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/firmo-scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the application's folder in the shared checkpoint
    folder; the application's folder goes when its driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _watched:
        _watched.add(app)
        atexit.register(clean_scratch, spark)
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clean_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote under its scratch folder."""
    try:
        remove_path(spark, scratch_root(spark))
    except Exception:  # noqa: BLE001  (the session may have ended before)
        pass


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def ensure_dir(path: str) -> None:
    p = local_path(path)
    if "://" not in p:
        os.makedirs(p, exist_ok=True)


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20,
               min_partitions: int = 200) -> dict[str, str]:
    """Shuffle and scan sizing for a given input volume.

    The initial shuffle width gives partitions of about ``target_partition_bytes``
    of input (so a full-width shuffle spills little); AQE then coalesces small
    partitions to the advisory size and splits skewed ones.  File splits are
    capped at the same size.  Pass the result as ``get_spark(extra=...)``."""
    n = max(min_partitions, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }
