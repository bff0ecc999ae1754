"""Spark session helpers.

``scratch_dir`` returns a folder under the cluster's ``spark.checkpoint.dir``
(a shared file system on a real cluster).  Only when the session has none
(local tests) is a private one created and registered.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession


# Settings for a large cluster reading ~100 TB (see README "Cluster settings").
CLUSTER_CONF = {
    # ~256 MB input splits: ~400k scan tasks for 100 TB, each far below executor memory
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    # for the many exchanges of partial sums and narrow keys: map tasks x partitions is the number of shuffle blocks,
    # so this stays at two per core of 1,000 executors; a job that shuffles whole rows passes ``input_bytes``
    # (see shuffle_partitions_for), and AQE merges small partitions
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split a reduce partition that is 5x the median and over 1 GB (hot keys in joins)
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    # broadcast only tables Spark has measured below 64 MB
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # Arrow batches for mapInPandas stay small per task
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    # delete checkpoint files once nothing references them (KNN rounds, OOF tables, quantile results)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 * 1024 * 1024, least: int = 8) -> int:
    """Shuffle partitions for a full shuffle of ``input_bytes`` in pieces of about ``target_bytes``."""
    return max(least, -(-int(input_bytes) // target_bytes))


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "tabforge",
              profile: str = "local", input_bytes: int | None = None) -> SparkSession:
    """Session with AQE and skew-join handling; ``profile="cluster"`` applies CLUSTER_CONF.

    On a cluster ``input_bytes``, the bytes that the job's widest exchange moves, raises the shuffle partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if profile == "cluster":
        for k, v in CLUSTER_CONF.items():
            builder = builder.config(k, v)
        shuffle_partitions = max(int(CLUSTER_CONF["spark.sql.shuffle.partitions"]), shuffle_partitions_for(input_bytes or 1))
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TABFORGE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir, creating a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="tabforge-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique folder inside the checkpoint dir for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def checkpoint_once(df):
    """Reliable checkpoint into the checkpoint dir, computing the plan only once.

    ``checkpoint(eager=True)`` runs the plan for its count and again for the
    write; caching first makes the write read the cached rows instead.  The
    cache is released once the files are written.
    """
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


_SHIPPED: set[int] = set()
_SHIP_LOCK = threading.Lock()  # models are fitted from several driver threads


def ship_package(spark: SparkSession) -> None:
    """Make ``tabforge`` importable in Python workers (what ``--py-files`` does).

    Functions run by ``mapInPandas`` refer to helpers in this package, which
    the executors must import.  The package is zipped once per process and
    added to the SparkContext once; Spark distributes it to every executor.
    """
    sc = spark.sparkContext
    key = id(sc._jsc)
    with _SHIP_LOCK:
        if key in _SHIPPED:
            return
        import shutil
        pkg_dir = os.path.dirname(os.path.abspath(__file__))
        out_dir = tempfile.mkdtemp(prefix="tabforge-pyfiles-")
        archive = shutil.make_archive(os.path.join(out_dir, "tabforge"), "zip",
                                      root_dir=os.path.dirname(pkg_dir), base_dir="tabforge")
        sc.addPyFile(archive)
        _SHIPPED.add(key)
