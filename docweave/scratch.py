"""Shared folders for checkpoints and for tables that a job writes and reads back."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="docweave-")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; only a local master may fall back to a temporary one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_dir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has been written to."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_tables(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables of a job by the paths it wrote them to."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def written_table(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """Write `df` once as Parquet below the shared folder and read it back.

    Later reads see the same rows however often they run, and lost executors cost no recomputation. The path is added
    to `paths`, for `remove_tables` when the job ends; without it the folder is left to the cluster's own clean-up.
    """
    path = fresh_path(df.sparkSession, name)
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
