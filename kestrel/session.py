"""Session helpers.

``local_session`` is for tests and the bench only.  On a cluster the
session comes from the deployment; the library only *reads* its settings.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Scratch folder of each application of this driver, by application id.
_SCRATCH: dict[str, str] = {}

# Settings that matter for every job here.  AQE re-plans at stage
# boundaries: coalesces small shuffle partitions, splits skewed join
# partitions, and turns a sort-merge join into a broadcast join when the
# *measured* size of a side is below the threshold.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "kestrel", extra_conf: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (no UI, UTC, AQE on).
    ``extra_conf`` adds settings, e.g. an event log folder for stage times."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or a checkpoint dir set on
    the context).  With neither set, a local master (tests) gets a fresh
    temporary folder; any other master raises, because a folder of the
    driver's machine cannot be read by executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             f"executors share (master is {sc.master})")
        configured = tempfile.mkdtemp(prefix="kestrel-ckpt-")
        _delete_on_exit(spark, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have the file system that holds ``path`` delete it when the driver's JVM ends."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root; it is deleted
    when the application ends."""
    sc = spark.sparkContext
    root = checkpoint_root(spark)
    own = os.path.join(root, "scratch", sc.applicationId)
    if _SCRATCH.get(sc.applicationId) != own:
        jvm = sc._jvm
        p = jvm.org.apache.hadoop.fs.Path(own)
        # deleteOnExit only takes a folder that exists
        p.getFileSystem(sc._jsc.hadoopConfiguration()).mkdirs(p)
        _delete_on_exit(spark, own)
        _SCRATCH[sc.applicationId] = own
    return os.path.join(own, f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df):
    """Compute ``df`` once into the shared checkpoint folder and return a
    DataFrame that reads it back.

    Used where later branches of a plan must see one fixed result (a range
    cut, a per-key table that was size-checked).  Unlike ``persist`` it
    holds no executor memory for the rest of the session, survives the loss
    of an executor, and cuts the lineage.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
