"""Table sources: documents and the control tables of the export queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The columns of a crawled document, in export order.
DOCUMENT_COLUMNS = [
    "doc_id", "doc_datetime", "doc_writer", "doc_url", "doc_title", "doc_content", "user_id", "view_count",
    "comment_count", "like_count", "dislike_count", "share_count", "locations", "depth1_nm", "depth1_seq",
    "depth2_nm", "depth2_seq", "depth3_nm", "depth3_seq", "item_grp_nm", "item_grp_seq", "item_nm", "item_seq",
]

QUEUE_SCHEMA = (
    "seq int, user_seq int, type_cd string, account_seq int, reg_dt timestamp_ntz, datasets string, "
    "channel string, start_date timestamp_ntz, end_date timestamp_ntz, compare_yn string, campaign_seq int, "
    "status string"
)
RULE_SCHEMA = (
    "rule_id int, dataset_seq int, use_yn string, keyword string, sub_keywords string, "
    "title_filter_keywords string, content_filter_keywords string, filter_urls string"
)


def read_table(spark: SparkSession, name_or_path: str, file_format: str = "parquet") -> DataFrame:
    """A catalog table, or a path when the name holds a slash."""
    if "/" in name_or_path:
        return spark.read.format(file_format).load(name_or_path)
    return spark.table(name_or_path)


# Folders of stored documents: the number of a month (12 * year + month) and the first channel number.
STORED_COLUMNS = ["stored_month", "stored_channel"]


def write_documents(docs: DataFrame, path: str) -> None:
    """Store documents by month and first channel, so that a request reads only the folders it can match.

    A month of a channel that holds much is written by several tasks.
    """
    month = 12 * F.year("doc_datetime") + F.month("doc_datetime")
    placed = docs.withColumns(dict(zip(STORED_COLUMNS, (month, F.col("depth1_seq").cast("int")))))
    placed.hint("rebalance", *STORED_COLUMNS).write.partitionBy(*STORED_COLUMNS).parquet(path)


def read_documents(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Documents with the columns of an export, and those of the folders they are stored in, if they are."""
    docs = read_table(spark, name_or_path)
    return docs.select(*DOCUMENT_COLUMNS, *[name for name in STORED_COLUMNS if name in docs.columns])


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A control table from a relational database; filters and columns are pushed down to it."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows of an input that was read in fewer partitions than there are cores.

    A table of many files is read in parallel as it is and is returned unchanged.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df
