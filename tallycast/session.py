"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every job of this package relies on. Sizes (shuffle partitions, memory) belong to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, app: str = "tallycast", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "12g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_own_roots: dict[str, str] = {}


def _shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a session whose tasks run in the driver's own process may do without the setting; it gets a temporary
    folder. Executors in processes of their own, local or not, would not see that.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if context.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _own_roots:
        _own_roots[context.applicationId] = tempfile.mkdtemp(prefix="tallycast-")
    return _own_roots[context.applicationId]


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared checkpoint directory; it is deleted when the session's process ends."""
    folder = os.path.join(_shared_root(spark), f"{purpose}-{uuid.uuid4().hex}")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path.getParent())
    files.deleteOnExit(path)
    return folder


def cut_lineage(df, purpose: str):
    """Write ``df`` to the shared folder and read it back, so later work does not recompute it.

    Unlike a cache, the files survive the loss of an executor.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
