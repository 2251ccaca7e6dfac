"""File sources: XML records, legacy charsets, tabular sheets and directory trees."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docweave.functions.text import is_blank
from docweave.session import allow_legacy_charsets
from docweave.sources.sheets import column_of, read_sheets

# Fields of an XML record and columns of a survey sheet.
RECORD = "DocId string, Content string, JSON string"
# The class of characters that cp949 is taken to hold: ASCII without the backslash, and Hangul syllables.
LEGACY_KEPT = r" -\[\]-~가-힣"
SURVEY_COLUMNS = ["case_id", "response_id", "answer_id", "language_id", "comment"]


def rootless_records(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """(value, record) of files of XML records without a root; `record._broken` is set where one cannot be parsed."""
    close = f"</{tag}>"
    records = spark.read.option("lineSep", close).text(path).where(~is_blank(F.col("value")))
    parsed = F.from_xml(
        F.concat("value", F.lit(close)), f"{schema}, _broken string", {"columnNameOfCorruptRecord": "_broken"}
    )
    return records.select("value", parsed.alias("record"))


def read_rootless_xml(spark: SparkSession, path: str, tag: str = "Doc", schema: str = RECORD) -> DataFrame:
    """Records of files that hold one XML record after the other, without a common root.

    The file is cut at the closing tag, so that large files stay splittable. Broken records are left to
    `quarantined_xml`.
    """
    records = rootless_records(spark, path, tag, schema).where(F.col("record._broken").isNull())
    return records.select("record.*").drop("_broken")


def quarantined_xml(spark: SparkSession, path: str, tag: str = "Doc", schema: str = RECORD) -> DataFrame:
    """The text of the records that `read_rootless_xml` cannot parse."""
    records = rootless_records(spark, path, tag, schema).where(F.col("record._broken").isNotNull())
    return records.select(F.col("value").alias("broken"))


def read_xml(spark: SparkSession, path: str, row_tag: str = "Doc", schema: str = RECORD, with_path: bool = False) -> DataFrame:
    """Records of well-formed XML files, whatever their root is called.

    A folder is read with all below it; `with_path` adds the `file_path` that a record came from.
    """
    records = spark.read.schema(schema).options(rowTag=row_tag, recursiveFileLookup=True).xml(path)
    return records.select(F.col("_metadata.file_path").alias("file_path"), "*") if with_path else records


def read_legacy_lines(spark: SparkSession, path: str, charset: str = "MS949") -> DataFrame:
    """Lines of text files in a legacy charset, as column `value`; blank lines and control characters stay."""
    allow_legacy_charsets(spark)
    # The text source hands on the bytes of a line as they are; no byte of a two-byte character is a line feed.
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.regexp_replace(F.decode(F.col("value").cast("binary"), charset), "\r$", "").alias("value"))


def legacy_text(text: Column, kept: str = LEGACY_KEPT) -> Column:
    """Text that a legacy charset can hold on one line: every character outside the class `kept` becomes an escape.

    An escape is a backslash and eight hexadecimal digits of the code point; backslashes are escaped too.
    """
    runs = F.regexp_extract_all(text, F.lit(f"(?s)[{kept}]+|."), F.lit(0))
    escaped = lambda run: F.concat(F.lit("\\"), F.hex(F.encode(run, "UTF-32")))
    return F.array_join(F.transform(runs, lambda run: F.when(F.rlike(run, F.lit(f"^[{kept}]")), run).otherwise(escaped(run))), "")


def restored_text(text: Column) -> Column:
    """The text that `legacy_text` was made from."""
    runs = F.regexp_extract_all(text, F.lit(r"\\[0-9A-F]{8}|[^\\]+"), F.lit(0))
    character = lambda run: F.decode(F.unhex(F.substr(run, F.lit(2))), "UTF-32")
    return F.array_join(F.transform(runs, lambda run: F.when(F.startswith(run, F.lit("\\")), character(run)).otherwise(run)), "")


def write_legacy_lines(lines: DataFrame, path: str, charset: str = "MS949") -> None:
    """The single text column of `lines` in a legacy charset, one line per row; see `legacy_text` for what that can hold."""
    allow_legacy_charsets(lines.sparkSession)
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.write.options(encoding=charset, sep="\u0001", quote="", escape="", **blanks).csv(path)


def convert_to_utf8(spark: SparkSession, path: str, out_path: str, charset: str = "MS949") -> None:
    """Rewrite legacy text as UTF-8 lines."""
    read_legacy_lines(spark, path, charset).write.text(out_path)


def add_xml_root(files: DataFrame, charset: str = "MS949") -> DataFrame:
    """Whole small files (as `binaryFile` reads them) as UTF-8 documents with a root element."""
    allow_legacy_charsets(files.sparkSession)
    head = '<?xml version="1.0" encoding="utf-8"?><Result>'
    return files.select("path", F.concat(F.lit(head), F.decode("content", charset), F.lit("</Result>")).alias("value"))


def read_survey_sheets(
    spark: SparkSession, paths: Sequence[str], columns: Sequence[str] = SURVEY_COLUMNS, with_path: bool = False
) -> DataFrame:
    """Rows of all sheets. Columns are found by the header of each sheet, so sheets may order them differently.

    A path may be a file or a folder of files with a header each. One large sheet is read by many tasks, also where its
    cells hold line breaks. A column that a sheet does not have is null. `with_path` adds the `file_path` of a row.
    """
    path = [F.col("path").alias("file_path")] if with_path else []
    return read_sheets(spark, paths).select(*path, *[column_of(c).alias(c) for c in columns])


def read_positional_sheet(spark: SparkSession, path: str, n_columns: int) -> DataFrame:
    """The first `n_columns` columns of a sheet with a header row, under their names."""
    rows = read_sheets(spark, [path])
    first = rows.select(F.slice("header", 1, n_columns).alias("names")).first()
    names = first.names if first else []
    return rows.select(*[F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(names)])


def read_tree(spark: SparkSession, path: str, schema: str | None = None, file_format: str = "csv", **options) -> DataFrame:
    """All files below a directory, or one file, with the `file_path` each row came from."""
    reader = spark.read.format(file_format).option("recursiveFileLookup", True).options(**options)
    if schema:
        reader = reader.schema(schema)
    return reader.load(path).select("*", F.col("_metadata.file_path").alias("file_path"))
