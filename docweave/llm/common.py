"""What the operators of this subpackage share: input columns, shared tables, code on the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docweave.bounds import broadcast_if_small
from docweave.scratch import remove_tables

# Rows and bytes up to which a measured side is broadcast.
SMALL_ROWS = 400_000
SMALL_BYTES = 24 * 1024 * 1024
#: Bytes that end a word: space and \t \n \v \f \r. Nothing else does.
WORD_GAP = "[\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of every row; a null text becomes the empty text. Other columns cannot clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def blocks(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what Python holds of them stays small; empty ones are left out."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def id_crc32(column: str = "doc_id") -> Column:
    """crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; only a local master may leave it unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix="docweave-llm-")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Whether Spark removes shuffle files once the query that made them has ended, not when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_temporary: list[list[str]] = []


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are removed at the end, unless they are written to be kept."""
    _temporary.append([])
    try:
        yield
    finally:
        remove_tables(spark, _temporary.pop())


def written(df: DataFrame, name: str, keep: bool = False, outer: bool = False) -> DataFrame:
    """`df` as a Parquet table in the shared folder: it cuts the lineage and survives lost executors.

    Shuffle files of the query go as soon as the table is written. Inside `temporary_tables` only a table to `keep` stays;
    of two such blocks, one inside the other, an `outer` table stays for the outer one.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    if _temporary and not keep:
        _temporary[-2 if outer else -1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """`df` marked for broadcast if it was measured small; else Spark shuffles and splits skewed keys."""
    return broadcast_if_small(df, SMALL_ROWS, SMALL_BYTES)


#: The setting that bounds the bytes of a batch sent to Python, its default, and the bound used here. Batches are
#: otherwise bounded by rows only, and a worker and the JVM each hold whole ones.
_BATCH, _BATCH_DEFAULT, _BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 64 * 1024 * 1024, "4m"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever the driver was started.

    Batches sent to Python are bounded to a few megabytes for the session, unless it sets a bound of its own.
    """
    sc = spark.sparkContext
    if spark.conf.get(_BATCH) == f"{_BATCH_DEFAULT}b":
        spark.conf.set(_BATCH, _BATCH_BYTES)
    if getattr(sc, "_docweave_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    archive = os.path.join(tempfile.mkdtemp(prefix="docweave-py-"), "docweave_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    sc.addPyFile(archive)
    sc._docweave_shipped = True
