"""The folder that driver and executors share, and tables written there for the time of a program."""

from __future__ import annotations

import atexit
import re
import threading
import uuid
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

#: Serves a single machine, as in tests.
LOCAL_DIR = "/tmp/checkpoints"

#: Folders still there, with their session and the thread that made them.
_live: dict[str, tuple[SparkSession, int]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.

    Where it is unset, a folder of this machine serves a local master; a cluster, whose
    executors would each write to a disk of their own, gets an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = LOCAL_DIR
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own, deleted when the program ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _live[path] = spark, threading.get_ident()
    return path


def folders() -> set[str]:
    """Those that this thread has made."""
    return {path for path, (_, thread) in _live.items() if thread == threading.get_ident()}


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(found: set[str]) -> None:
    for folder in found & set(_live):
        delete(_live.pop(folder)[0], folder)


@contextmanager
def temporary():
    """Folders made inside, by this thread, are deleted at the end: for programs that live long. Results must have been written or collected by then."""
    before = folders()
    try:
        yield
    finally:
        discard(folders() - before)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table, for what several branches of a plan read: it is computed once, and lost executors cost no more than a task."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _discard_all() -> None:
    for folder, (spark, _) in _live.items():
        with suppress(Exception):  # the session may have ended
            delete(spark, folder)
