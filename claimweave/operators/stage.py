"""Materialise a frame that several branches of a job read."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import cache

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back as a parquet table.

    The written table cuts the lineage, survives lost executors and still prunes columns. A session
    on one machine that names no shared folder gets a folder of its own, removed when it ends; on a
    cluster the setting is required.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path that no other table has, on the cluster's shared folder."""
    shared = spark.conf.get(CHECKPOINT_SETTING, None)
    if not shared and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        shared = _own_folder()
    if not shared:
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    return f"{shared.rstrip('/')}/claimweave/{label}-{uuid.uuid4().hex}"


def stage_together(**frames: DataFrame) -> list[DataFrame]:
    """Stage frames that don't depend on each other at the same time, so that none waits for another's last tasks."""
    with ThreadPoolExecutor(len(frames)) as pool:
        jobs = [
            pool.submit(inheritable_thread_target(df.sparkSession)(stage), df, label)
            for label, df in frames.items()
        ]
        return [job.result() for job in jobs]


@cache
def _own_folder() -> str:
    folder = tempfile.TemporaryDirectory(prefix="claimweave-")
    atexit.register(folder.cleanup)
    return folder.name


def release(df: DataFrame) -> None:
    """Give back the storage of a persisted frame; written tables stay for the cluster to expire."""
    if df.is_cached:
        df.unpersist()
