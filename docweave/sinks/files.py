"""File sinks. Every writer runs in parallel and writes one folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.sinks.rows import wide_topics
from docweave.sources.tables import DOCUMENT_COLUMNS


# Values are quoted as needed, keep their outer blanks, and are empty when null.
_PAGE = {"escape": '"', "nullValue": "", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_delimited(df: DataFrame, path: str, sep: str = "\t", header: bool = False, mode: str = "errorifexists") -> None:
    """Delimited rows; values that hold the delimiter or a quote are quoted, nulls are empty."""
    df.write.mode(mode).options(sep=sep, header=header, escape='"', emptyValue="", nullValue="").csv(path)


def write_lines(df: DataFrame, path: str, append: bool = False) -> None:
    """The single text column of `df`, one line per row."""
    df.write.mode("append" if append else "errorifexists").text(path)


def write_topic_columns(rows: DataFrame, path: str, topics_col: str = "topics", n_topics: int | None = None) -> None:
    """Source columns and then one column per topic, with a header row.

    Without `n_topics` the longest list decides, which takes one pass over the list sizes.
    """
    if n_topics is None:
        n_topics = rows.agg(F.max(F.size(topics_col))).first()[0] or 0
    write_delimited(wide_topics(rows, topics_col, n_topics), path, sep=",", header=True)


def write_pages(paged: DataFrame, path: str, columns: Sequence[str] = DOCUMENT_COLUMNS) -> None:
    """One file with a header row per page. Pages of the same name are replaced, all others stay.

    Input has `directory`, `file_name` and `page` next to the document columns. Pages are the unit of
    shuffling: they have a bounded size, however large the export they belong to is.
    """
    # A slash would be escaped in a partition folder, so date and request become two levels.
    parts = F.split("directory", "/", -1)
    (
        paged.select(parts[0].alias("reg_dt"), parts[1].alias("seq"), "file_name", *columns, "row_no")
        .repartition("reg_dt", "seq", "file_name")
        .sortWithinPartitions("reg_dt", "seq", "file_name", "row_no")
        .drop("row_no")
        .write.partitionBy("reg_dt", "seq", "file_name")
        .mode("overwrite")
        .options(header=True, partitionOverwriteMode="dynamic", **_PAGE)
        .csv(path)
    )


def read_pages(spark: SparkSession, path: str, columns: Sequence[str] = DOCUMENT_COLUMNS) -> DataFrame:
    """Rows of pages, all columns as text, with the columns that their folders are named by.

    An empty value comes back as null. Cells may hold line breaks, so a page, which is bounded, is read by one task.
    """
    folders = ["run", "reg_dt", "seq", "file_name"]
    schema = ", ".join(f"{name} string" for name in [*columns, *folders])
    return spark.read.schema(schema).options(header=True, multiLine=True, enforceSchema=True, **_PAGE).csv(path)


def write_pages_unordered(matched: DataFrame, path: str, size: int, columns: Sequence[str] = DOCUMENT_COLUMNS) -> None:
    """Files of at most `size` rows per (request, dataset), without a shuffle and without a fixed order."""
    (
        matched.select("seq", "dataset_seq", *columns)
        .write.partitionBy("seq", "dataset_seq")
        .options(header=True, escape='"', maxRecordsPerFile=size)
        .csv(path)
    )
