"""Delimited sheets that are read by many tasks although their cells may hold line breaks.

A sheet is read as plain lines, so that it can be split anywhere between lines. Whether a line begins inside a quoted
cell follows from the number of quotes before it: each split counts its own, and a running sum over the few rows of the
splits tells what each begins with. Lines that are whole records stay as they are; only those of records with line
breaks are brought together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from docweave.bounds import broadcast_if_small
from docweave.scratch import written_table

_BOM = "﻿"


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """`path`, `block` (where its split begins), `line_no` (rising within a split), `value`, `odd` (1 for an odd number of quotes)."""
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.options(lineSep="\n", recursiveFileLookup=True).text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"), "value", (quotes % 2).alias("odd"),
    )


def read_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, record_no, record): the records of all sheets, numbered from 1 within a sheet.

    A record ends at a line break outside quotes. Quotes inside a quoted cell are doubled, and a cell with a quote is
    quoted, as all common writers do. A record with line breaks may span any number of splits.
    """
    in_split = Window.partitionBy("path", "block").orderBy("line_no")
    before, so_far = in_split.rowsBetween(Window.unboundedPreceding, -1), in_split.rowsBetween(Window.unboundedPreceding, 0)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    lines = _lines(spark, paths).withColumn("inside", inside)
    # Records that begin so far, if the split begins outside or inside a quoted cell.
    lines = lines.withColumns({f"begun_{i}": F.sum(F.when(F.col("inside") == i, 1).otherwise(0)).over(so_far) for i in (0, 1)})
    lines = written_table(lines, "lines")
    splits = lines.groupBy("path", "block").agg((F.sum("odd") % 2).alias("odd"), F.max("begun_0").alias("n_0"), F.max("begun_1").alias("n_1"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("start", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("start") == 0, F.col("n_0")).otherwise(F.col("n_1"))
    splits = splits.withColumn("records_before", F.coalesce(F.sum(begun).over(earlier), F.lit(0))).select("path", "block", "start", "records_before")
    placed = lines.join(broadcast_if_small(splits), ["path", "block"]).select(
        "path", "block", "line_no", "value", "odd",
        (F.col("records_before") + F.when(F.col("start") == 0, F.col("begun_0")).otherwise(F.col("begun_1"))).alias("record_no"),
        ((F.col("start") + F.col("inside")) % 2 == 0).alias("first"),
    )
    whole = F.col("first") & (F.col("odd") == 0)
    parts = placed.where(~whole).groupBy("path", "record_no").agg(F.array_sort(F.collect_list(F.struct("block", "line_no", "value"))).alias("parts"))
    joined = parts.select("path", "record_no", F.array_join(F.col("parts.value"), "\n").alias("record"))
    records = placed.where(whole).select("path", "record_no", F.col("value").alias("record")).unionByName(joined)
    return records.withColumn("record", F.regexp_replace("record", "\r$", ""))


def _cells(record: Column, n: int, sep: str) -> Column:
    """The cells of a record as text; null for empty ones, and for those that a short record lacks."""
    schema = ", ".join(f"c{i} string" for i in range(n))
    parsed = F.from_csv(record, F.lit(schema), {"sep": sep, "quote": '"', "escape": '"'})
    return F.array(*[parsed[f"c{i}"] for i in range(n)])


def read_sheets(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> DataFrame:
    """(path, header, cells) of the rows of all sheets: `header` and `cells` are arrays of text. Blank rows are left out."""
    records = read_records(spark, paths).where(F.col("record") != "")
    unmarked = F.regexp_replace("record", f"^{_BOM}", "")
    # One row per sheet.
    firsts = written_table(records.where(F.col("record_no") == 1).select("path", unmarked.alias("first")), "headers")
    separators = F.char_length("first") - F.char_length(F.replace("first", F.lit(sep), F.lit("")))
    n = firsts.agg(F.max(separators)).first()[0]
    width = 1 if n is None else n + 1  # no sheet has more columns
    cells = _cells(F.col("first"), width, sep)
    headers = firsts.select(F.col("path").alias("_path"), F.filter(cells, lambda c: c.isNotNull()).alias("header"))
    rows = records.where(F.col("record_no") > 1).select("path", _cells(F.col("record"), width, sep).alias("cells"))
    return rows.join(broadcast_if_small(headers), F.col("path") == F.col("_path")).select("path", "header", "cells")


def column_of(name: str) -> Column:
    """The cell of a row of `read_sheets` under a header; null where the sheet has no such column."""
    return F.get("cells", F.nullif(F.array_position("header", F.lit(name)), F.lit(0)).cast("int") - 1)
