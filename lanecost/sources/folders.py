"""Where intermediate tables are written."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


_given: list[str] = []


@cache
def _own_folder() -> str:
    """A temporary folder of this process, which goes with it."""
    folder = tempfile.mkdtemp(prefix="lanecost-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which every executor can
    reach. Only a local session that names none, as in tests, gets a temporary
    folder of this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
        root = _own_folder()
    folder = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _given.append(folder)
    return folder


def remove_shared_folders(spark: SparkSession) -> list[str]:
    """Delete the folders that this process was given so far, once nothing that reads
    them is still to run; returns those that were there."""
    removed = []
    while _given:
        path = spark._jvm.org.apache.hadoop.fs.Path(_given.pop())
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True):
            removed.append(path.toString())
    return removed
