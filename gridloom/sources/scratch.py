"""A place for files of queries that write and read back: in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path below spark.checkpoint.dir; below a temporary folder only where that is unset and all runs in one process."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="gridloom-files-")
    made = f"{shared.rstrip('/')}/gridloom-files/{uuid.uuid4().hex}-{name}"
    _made.append((spark, made))
    return made


_made: list[tuple[SparkSession, str]] = []


@atexit.register
def clear() -> None:
    """Deletes all scratch folders. Frames that read them can't be evaluated afterwards."""
    while _made:
        spark, path = _made.pop()
        try:
            fs, at = filesystem(spark, path)
            fs.delete(at, True)
        except Exception:  # the session has gone
            return


def filesystem(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path for it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at
