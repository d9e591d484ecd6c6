"""Results written once to the cluster's shared checkpoint folder and read back."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from voltlake.sources.files import delete


@cache
def own_folder() -> str:
    """A folder of this process, removed with it: enough for local mode, where all tasks run in it."""
    folder = tempfile.mkdtemp(prefix="voltlake-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor reaches: ``spark.checkpoint.dir``, which a cluster has to set.

    The session's settings are read, never changed.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("Set spark.checkpoint.dir to a folder shared by the cluster")
    return own_folder()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/voltlake-{name}-{uuid4().hex}"


@contextmanager
def staged(rows: DataFrame, *by: str) -> Iterator[DataFrame]:
    """``rows`` computed once into a table that is gone after the block, with a folder for each value of ``by``.

    What reads it several times (keys, periods, rows) scans Parquet columns instead of repeating the
    work, and a lost executor costs a re-read, not a recomputation.
    """
    spark = rows.sparkSession
    folder = new_folder(spark, "stage")
    rows.write.partitionBy(*by).parquet(folder)
    try:
        yield spark.read.schema(rows.schema).parquet(folder)
    finally:
        delete(spark, folder)
