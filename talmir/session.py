"""Where jobs keep what they write between stages."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


_local_folders: list[str] = []


@atexit.register
def _remove_local_folders() -> None:
    for folder in _local_folders:
        shutil.rmtree(folder, ignore_errors=True)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.

    Where none is set, a local master gets a temporary one, removed when Python ends. On a
    cluster that is an error: executors do not see each other's folders.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share ({master})")
    folder = tempfile.mkdtemp(prefix="talmir-")
    _local_folders.append(folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows, computed once and read back from the shared folder."""
    folder = shared_folder(df.sparkSession)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()
