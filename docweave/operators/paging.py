"""Row positions and pages of export results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from docweave.bounds import broadcast_if_small
from docweave.scratch import written_table

# Fixed value: rows of a page.
PAGE_SIZE = 10_000
_LOCAL_BITS = 33


def add_positions(df: DataFrame, groups: Sequence[str], order: Sequence[str], out_col: str = "position") -> DataFrame:
    """Number the rows of every group from 0 in the given order, which must be total.

    Rows are range-sorted over (group, order), so a group that holds most of the table is spread over many
    tasks. The sorted rows are written once, because a second run of the sort may cut its ranges elsewhere; then
    only the row count of each (partition, group) has to be summed up.
    """
    numbered = (
        df.repartitionByRange(*groups, *order)
        .sortWithinPartitions(*groups, *order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    frozen = written_table(numbered, "positions").withColumns(
        {"_partition": F.shiftright("_mid", _LOCAL_BITS), "_local": F.col("_mid").bitwiseAND((1 << _LOCAL_BITS) - 1)}
    )
    keys = [F.coalesce(F.col(g).cast("string"), F.lit("")).alias(f"_g{i}") for i, g in enumerate(groups)]
    names = [f"_g{i}" for i in range(len(groups))]
    pieces = frozen.groupBy("_partition", *keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first"))
    earlier = Window.partitionBy(*names).orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        "_partition", *names, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_offset")
    )
    return (
        frozen.select("*", *keys)
        .join(broadcast_if_small(offsets), ["_partition", *names])
        .withColumn(out_col, F.col("_local") + F.col("_offset"))
        .select(*df.columns, out_col)
    )


def add_pages(
    matched: DataFrame,
    size: int = PAGE_SIZE,
    groups: Sequence[str] = ("seq", "dataset_seq"),
    order: Sequence[str] = ("doc_datetime", "doc_id"),
) -> DataFrame:
    """Add `page`, counted from 0, and `row_no`, the position on the page."""
    positioned = add_positions(matched, groups, order)
    return positioned.select(
        *matched.columns,
        F.floor(F.col("position") / size).cast("bigint").alias("page"),
        (F.col("position") % size).cast("bigint").alias("row_no"),
    )


def page_suffix(page: Column) -> Column:
    """Nothing for the first file of an export, `(1)`, `(2)` … for the next ones."""
    return F.when(page > 0, F.concat(F.lit("("), page.cast("string"), F.lit(")"))).otherwise(F.lit(""))


def manifest(named_requests: DataFrame, matched: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """One row per page file, and one row without a page for a (request, dataset) that matched nothing.

    `named_requests` has one row per (request, dataset) with `directory` and `file_name`.
    """
    totals = matched.groupBy("seq", "dataset_seq").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col("seq").alias("_seq"), F.col("dataset_seq").alias("_ds"), "_n"
    )
    same = (F.col("seq") == F.col("_seq")) & F.col("dataset_seq").eqNullSafe(F.col("_ds"))
    total = F.coalesce("_n", F.lit(0))
    pages = F.when(total > 0, F.sequence(F.lit(0).cast("bigint"), F.ceil(total / size).cast("bigint") - 1))
    return (
        named_requests.join(totals, same, "left")
        .select("seq", "dataset_seq", "directory", "file_name", total.alias("total"), F.explode_outer(pages).alias("page"))
        .select(
            "seq", "dataset_seq", "directory",
            F.when(F.col("page").isNotNull(), F.concat("file_name", page_suffix(F.col("page")))).alias("file_name"),
            "total", "page",
            F.when(F.col("page").isNotNull(), F.least(F.lit(size).cast("bigint"), F.col("total") - F.col("page") * size))
            .otherwise(F.lit(0)).cast("bigint").alias("n_rows"),
        )
    )
