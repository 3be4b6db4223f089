"""Session settings and storage folders.

Written tables go to the catalog's warehouse; checkpoints and staged facts go to
the folder in ``spark.checkpoint.dir``. On a cluster both must be shared: a
folder that tasks do not see is refused.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every job of the mart relies on. AQE re-plans joins from runtime
# sizes (broadcast only when the measured side is small), coalesces small
# shuffle partitions and splits skewed join partitions.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.exchange.reuse": "true",
}


def apply_job_conf(spark: SparkSession) -> SparkSession:
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tarmac") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _seen_by_tasks(spark: SparkSession, folder: str) -> bool:
    """Whether tasks see a file that the driver puts into the local ``folder``, as
    they do where the machines mount one file system. A few tasks for every core."""
    try:
        sc = spark.sparkContext
    except Exception:
        return False
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_seen_{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.create(path, False).close()
    try:
        name, tasks = path.toUri().getPath(), 4 * sc.defaultParallelism
        return all(sc.parallelize(range(tasks), tasks).map(lambda _: os.path.exists(name)).collect())
    finally:
        fs.delete(path, False)


def _shared(spark: SparkSession, folder: str) -> str:
    """``folder``, which other machines must reach: a local folder is refused
    unless the whole session runs on this machine or all tasks see the folder."""
    scheme = folder.split(":", 1)[0] if "://" in folder or folder.startswith("file:") else ""
    named = spark.conf.get("fs.defaultFS", None) or spark.conf.get("spark.hadoop.fs.defaultFS", "file:///")
    local = scheme == "file" or (not scheme and named.startswith("file:"))
    master = spark.conf.get("spark.master", "local")
    if local and not master.startswith("local") and not _seen_by_tasks(spark, folder):
        raise ValueError(f"{folder} is a folder of one machine, but the master is {master}: "
                         "set spark.checkpoint.dir and spark.sql.warehouse.dir to shared storage")
    return folder.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """Folder for what a run may lose afterwards (checkpoints, staged facts):
    ``spark.checkpoint.dir``, or a folder beside the tables where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return _shared(spark, named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tarmac_scratch")


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """The session's checkpoint directory, set under :func:`scratch_root` if the
    session has none yet. Without a reachable SparkContext (Spark Connect) the
    server's own setting applies and None is returned."""
    try:
        sc = spark.sparkContext
    except Exception:
        return None
    current = sc.getCheckpointDir()
    if current:
        return current
    sc.setCheckpointDir(scratch_root(spark))
    return sc.getCheckpointDir()


def storage_root(spark: SparkSession) -> str:
    """Shared folder for written tables: the catalog's warehouse, never the
    checkpoint folder, which may be purged."""
    return _shared(spark, spark.conf.get("spark.sql.warehouse.dir"))


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder of this run, on whatever storage it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
