"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every pitwall job relies on. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # target post-shuffle partition size; AQE merges small partitions up to it
    # and splits join partitions above skewedPartitionFactor x median / threshold
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.session.timeZone": "UTC",
    # RDD-level data (checkpoints, ML caches) serialise with Kryo, not Java
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(
    master: str | None = None,
    app_name: str = "pitwall",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with pitwall's defaults.

    ``master`` is only set when given, so on a cluster the launcher decides.
    For local runs the driver binds to loopback to keep large collects stable.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.host", "127.0.0.1").config(
                "spark.driver.bindAddress", "127.0.0.1"
            )
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives this package to the session's Python workers, once per application: their
    functions are pickled by name, and an executor need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    top = os.path.dirname(os.path.abspath(__file__))
    # the driver serves the file to all executors
    path = os.path.join(tempfile.mkdtemp(prefix="pitwall-package-"), "pitwall.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder and is used as is; a cluster session without it is refused, as its
    executors would not share a local one. Local test sessions usually leave it
    unset; then a fresh folder under the system temp dir is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="pitwall-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for a written intermediate table next to the checkpoints."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name)
