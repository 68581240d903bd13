"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where the aggregate above it needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "areacast", **settings: str) -> SparkSession:
    """Session for the jobs; the master and the sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The folder shared by all executors, as ``spark.checkpoint.dir`` names it.

    Only a local master may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="areacast-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def hadoop_folder(spark: SparkSession, path: str):
    """The file system of a path and the path in its terms."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()), folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the work folder; Hadoop drops it when the session ends."""
    path = f"{work_root(spark).rstrip('/')}/areacast/{name}-{uuid.uuid4().hex}"
    system, folder = hadoop_folder(spark, path)
    system.deleteOnExit(folder)
    return path
