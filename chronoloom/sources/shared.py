"""The folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: application -> its folder, where none is named.
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only where that is unset and Spark runs in one process, as in tests, a local folder."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = spark.sparkContext.applicationId
    if own not in _LOCAL:
        _LOCAL[own] = tempfile.mkdtemp(prefix="spark-")
    return _LOCAL[own]


def files_of(spark: SparkSession, path: str):
    """The file system of a path, and the path in it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def scratch(spark: SparkSession, kind: str) -> str:
    """A new folder's name in the shared one, not made yet; what is written there goes when the application ends."""
    path = f"{shared_dir(spark)}/chronoloom-{kind}-{uuid.uuid4().hex}"
    files, at = files_of(spark, path)
    files.mkdirs(at)  # what is not there yet can't be marked for deletion
    files.deleteOnExit(at)
    return f"{path}/data"
