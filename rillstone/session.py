"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Only settings the operators' results or plans depend on. Memory, cores, connectors and
# shuffle width belong to the deployment.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Settings that can only be given when the session is made. Without call-site capture a plan takes half the
# time to build, which a job pays for in every micro-batch.
AT_START = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app_name: str = "rillstone", **extra: str) -> SparkSession:
    """A session with the library's settings and any others given as extra."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **AT_START, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else made. All of them can be changed at run time."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a local master may fall back to a machine-local folder: on a cluster the executors could not
    see it, and it would be lost with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rillstone-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses. It is not created here, and deleted when the
    session's JVM ends in good order."""
    folder = f"{shared_folder(spark)}/rillstone/{label}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder
