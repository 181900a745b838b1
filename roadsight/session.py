"""Session and scratch-location helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Configuration a production job would also carry.  AQE re-plans joins and
# coalesces/splits skewed shuffle partitions with runtime statistics.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "roadsight",
              extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters pass their own session."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is read from the
    session; where it is missing there, this is an error, as a folder of the
    driver's own disk would be unseen by executors.  Only a ``local`` master
    gets a private folder, so that tests and small runs need no setting.
    """
    sc = spark.sparkContext
    jdir = sc._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get()
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="roadsight-ckpt-")
    sc.setCheckpointDir(root)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root (never reused), made by its own file system."""
    root = checkpoint_root(spark)
    path = root.rstrip("/") + f"/roadsight-{name}-{uuid.uuid4().hex[:12]}"
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(sc._jsc.hadoopConfiguration()).mkdirs(hadoop)
    return path
