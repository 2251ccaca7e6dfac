"""Jobs from a folder of files to a folder of outputs, one output per input file.

All files of a folder, and of the folders in it, are read together as one table with the path of each row. An output is
a folder named like its input with another extension; a large input's output is written by many tasks. Inputs that give
no rows have no output.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docweave.functions.tags import KOREAN, Letters
from docweave.operators import payload
from docweave.operators.requests import swap_extension
from docweave.plans import jobs
from docweave.sinks.files import write_lines
from docweave.sources.files import read_survey_sheets, read_xml

PATH = ["file_path"]


@dataclass(frozen=True)
class Dictionaries:
    """What the text jobs look words up in."""

    lexicon: DataFrame
    verb_dict: DataFrame
    category: DataFrame
    letters: Letters = KOREAN


def output_name(in_dir: str, extension: str, spark: SparkSession) -> Column:
    """The path of a row's file below `in_dir`, with its extension replaced; only the name if `in_dir` is a file."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(in_dir)
    prefix = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toUri().toString().rstrip("/") + "/"
    # Paths of rows are written with one slash or three after the scheme.
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    path, start = plain(F.col("file_path")), plain(F.lit(prefix))
    below = F.when(F.startswith(path, start), F.substr(path, F.char_length(start) + 1)).otherwise(F.element_at(F.split(path, "/"), -1))
    return swap_extension(F.url_decode(F.replace(below, F.lit("+"), F.lit("%2B"))), extension)


def write_outputs(rows: DataFrame, in_dir: str, out_dir: str, extension: str, sep: str | None = None) -> None:
    """Rows with a `file_path` to `out_dir/output=<name>`: delimited with `sep`, or the one other column as lines.

    A slash in a name is written as %2F, as in all partition folders. Outputs of the same name are replaced.
    """
    named = rows.withColumn("output", output_name(in_dir, extension, rows.sparkSession)).drop("file_path")
    writer = named.write.partitionBy("output").mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if sep is None:
        writer.text(out_dir)
    else:
        blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer.options(sep=sep, escape='"', nullValue="", emptyValue="", **blanks).csv(out_dir)


def _records(spark: SparkSession, in_dir: str) -> DataFrame:
    return payload.cleaned_records(read_xml(spark, in_dir, with_path=True))


def _tagged(spark: SparkSession, in_dir: str, words: Dictionaries, carried: tuple[str, ...] = ()) -> DataFrame:
    return jobs.tagged_sentences(_records(spark, in_dir), words.lexicon, [*PATH, "doc_id", *carried], "content", letters=words.letters)


def _survey(spark: SparkSession, in_dir: str, words: Dictionaries) -> DataFrame:
    rows = read_survey_sheets(spark, [in_dir], with_path=True)
    return jobs.survey_sentences(rows, words.lexicon, words.letters, PATH)


def cause_verbs(spark: SparkSession, in_dir: str, out_dir: str, words: Dictionaries) -> None:
    """XML records with matching payloads to tab-separated rows: id, content, cause, verb, emotion."""
    analyse = jobs.cause_analyser(words.lexicon, words.letters)
    found = jobs.cause_verbs(_records(spark, in_dir), words.verb_dict, analyse, [*PATH, "doc_id", "content"])
    write_outputs(found.select(*PATH, "doc_id", "content", "value", "verb", "emotion"), in_dir, out_dir, ".result", "\t")


def attribute_rows(spark: SparkSession, in_dir: str, out_dir: str, words: Dictionaries) -> None:
    """XML records to tab-separated attributes; a sentence without clauses keeps a row."""
    found = jobs.attribute_rows(_tagged(spark, in_dir, words), words.verb_dict, words.category, PATH)
    write_outputs(found.drop("sentence_idx", "clause_idx", "attr_idx"), in_dir, out_dir, ".result", "\t")


def survey_attributes(spark: SparkSession, in_dir: str, out_dir: str, words: Dictionaries) -> None:
    """Sheets of comments to attributes separated by semicolons."""
    found = jobs.survey_attributes(_survey(spark, in_dir, words), words.verb_dict, words.category, PATH)
    write_outputs(found.drop("sentence_idx", "clause_idx"), in_dir, out_dir, ".result", ";")


def clause_documents(spark: SparkSession, in_dir: str, out_dir: str, words: Dictionaries) -> None:
    """XML records to index documents, one JSON line per clause."""
    write_outputs(jobs.clause_documents(_tagged(spark, in_dir, words), words.verb_dict, PATH).drop("id"), in_dir, out_dir, ".json")


def survey_documents(spark: SparkSession, in_dir: str, out_dir: str, words: Dictionaries) -> None:
    """Sheets of comments to index documents, one JSON line per clause."""
    write_outputs(jobs.survey_documents(_survey(spark, in_dir, words), words.verb_dict, PATH).drop("id"), in_dir, out_dir, ".json")


def tagged_records(date: str) -> Callable[[SparkSession, str, str, Dictionaries], None]:
    """XML records to records of the tagged format, dated `date` (yyyyMMdd)."""

    def job(spark: SparkSession, in_dir: str, out_dir: str, words: Dictionaries) -> None:
        tagged = _tagged(spark, in_dir, words, ("content",))
        found = jobs.tagged_records(tagged, words.verb_dict, words.category, date, carried=PATH)
        write_outputs(found.drop("id"), in_dir, out_dir, ".SCD")

    return job


def write_corpus(records: DataFrame, folder: str, stamp: datetime, append_to: str | None = None) -> str:
    """Corpus lines of raw records, appended to a file, or written to a new one named by the minute of `stamp`."""
    path = append_to or f"{folder.rstrip('/')}/{stamp:%Y%m%d%H%M}.txt"
    write_lines(jobs.corpus(records).select("line"), path, append=append_to is not None)
    return path
