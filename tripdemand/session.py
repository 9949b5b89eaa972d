"""Session construction and shared storage locations."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on. Timestamps in the trip files carry no zone, so
# the session zone is pinned to UTC; the column helpers are written to be
# zone-independent anyway (see functions.columns).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoints that nothing refers to any more are deleted
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Settings for a large cluster (hundreds of executors, tens of TB per job).
# Shuffle partitions are an upper bound: AQE merges them down to the advisory
# size from measured map output, and splits skewed ones. Scan splits of 256 MB
# keep tasks few but evenly sized; the broadcast threshold stays modest,
# because every broadcast copy lands on every executor (fixed-size dimensions
# are hinted explicitly, data-derived sides are left to AQE's measured sizes).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tripdemand", extra_conf: dict | None = None,
              cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster, leave ``master`` unset and pass ``cluster=True`` for the
    large-job settings above; ``spark.checkpoint.dir`` must name shared storage.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    The setting is read from the session. Only a local session (tests, bench)
    without the setting gets a private scratch folder; a cluster session
    without it is an error, because a machine-local folder would not survive
    the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/object store) before running jobs that cut lineage")
        configured = tempfile.mkdtemp(prefix="tripdemand-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever file system it names."""
    stored = spark._jvm.org.apache.hadoop.fs.Path(path)
    return stored.getFileSystem(spark._jsc.hadoopConfiguration()).exists(stored)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for written tables."""
    root = checkpoint_dir(spark)
    return f"{root.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package: sent once a session, unless their path names it."""
    sc = spark.sparkContext
    package = Path(__file__).resolve().parent
    if str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_has_package", None):
        return
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"  # the driver's own copy; Spark sends it on
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._has_package = True
