"""Session defaults and the shared scratch location.

Nothing in the library creates a session on its own; operators take
DataFrames. This module only helps scripts and tests build one with the
settings the operators assume (UTC session time zone, AQE on), and gives
jobs a place for checkpoints and stream state that is shared by the whole
cluster.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every operator relies on. The time zone makes epoch maths and
# calendar functions agree with a UTC oracle; AQE re-plans joins from
# runtime sizes (broadcast only when the measured side is small) and splits
# skewed shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Reliable checkpoints of the caller's own are deleted once their DataFrame
    # is garbage-collected; written tables stay until clear_scratch().
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tessera",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the library's defaults.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster
    leave them ``None`` and let spark-submit decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of any cluster:
    the driver serves a zip of it to every executor, as ``--py-files`` does
    at submit time. Done once per application.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="tessera-pyfiles-"), "tessera.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder, registered with the
    SparkContext so that ``DataFrame.checkpoint()`` can use it.

    The folder named by ``spark.checkpoint.dir`` is used. Only a local master,
    whose tasks all run on this machine, may leave it unset; it then gets a
    folder that goes when the driver exits.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SCRATCH: dict[str, list[str]] = {}  # by application


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder.

    Stream checkpoints and written intermediate tables go here, so that a
    lost executor or a restarted driver finds them. They are read when the
    results are, so they stay until :func:`clear_scratch`.
    """
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in any file system that Spark can reach."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any file system that Spark can reach."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate data, once the results that
    were made from it have been written or read."""
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        delete_path(spark, path)
