"""Commits that several runs share: small files of which one writer wins, and a log of request statuses on top of them."""

from __future__ import annotations

import uuid
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

STATUS_SCHEMA = "seq bigint, status string, run_id string, expires timestamp"


def publish_once(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file at `path` unless there is one already; of several writers exactly one gets True.

    The file appears with its whole text, by a rename that does not overwrite.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    files = jvm.org.apache.hadoop.fs
    target = files.Path(path)
    system = target.getFileSystem(conf)
    target = system.makeQualified(target)
    staged = files.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = system.create(staged, False)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(files, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        files.FileContext.getFileContext(target.toUri(), conf).rename(staged, target, options)
    except Py4JJavaError as error:
        system.delete(staged, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


class StatusLog:
    """Events (seq, event_no, status, run_id, expires) in batches that are written first and then committed by number.

    A batch is committed as the successor of the version its writer has read; of two writers that have read the same
    version one commits, the other reads again. All events of a batch have its number, so later ones are larger.
    Batches that were never committed are not seen.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def version(self) -> int:
        """The number of the last commit, 0 before the first."""
        commits = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        system = commits.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(commits):
            return 0
        names = (status.getPath().getName() for status in system.listStatus(commits))
        return max((int(name) for name in names if name.isdigit()), default=0)

    def events(self, version: int | None = None) -> DataFrame:
        """Committed events up to `version`."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], f"seq bigint, event_no bigint, {STATUS_SCHEMA.partition(', ')[2]}")
        number = F.col("_metadata.file_name").cast("bigint")
        commits = self.spark.read.text(f"{self.path}/commits").select(number.alias("event_no"), F.col("value").alias("_batch"))
        events = self.spark.read.schema(f"{STATUS_SCHEMA}, _batch string").parquet(f"{self.path}/events/*")
        return (
            events.join(F.broadcast(commits.where(F.col("event_no") <= version)), "_batch")  # one row per run and step
            .select("seq", "event_no", "status", "run_id", "expires")
        )

    def append(self, requests: DataFrame, status: str, after: int, run_id: str | None = None, expires: datetime | None = None) -> bool:
        """Commit one event for each `seq` of `requests`, unless something was committed after version `after`."""
        batch = uuid.uuid4().hex
        rows = requests.select(
            F.col("seq").cast("bigint").alias("seq"), F.lit(status).alias("status"), F.lit(run_id).cast("string").alias("run_id"),
            F.lit(expires).cast("timestamp").alias("expires"), F.lit(batch).alias("_batch"),
        ).distinct()
        rows.write.parquet(f"{self.path}/events/{batch}")
        return publish_once(self.spark, f"{self.path}/commits/{after + 1:020d}", batch)
