"""JSON payloads of tagged or matched documents. A payload is an object body without its outer braces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docweave.functions.dictionary import let
from docweave.functions.text import clean_id, corpus_line, strip, without_line_breaks

CHECKED_PAYLOAD = "struct<result:array<struct<kma:string>>,broken:string>"
MATCHING_PAYLOAD = (
    "struct<result:array<struct<sentence:struct<string:string>,"
    "matched_text:struct<string:string,begin:int>,variables:array<struct<value:string>>>>>"
)
OK, NO_RESULT, UNDECODABLE = "ok", "no_result", "undecodable"


def _whole(body: Column) -> Column:
    return F.concat(F.lit("{"), F.coalesce(body, F.lit("")), F.lit("}"))


def parse(body: Column, schema: str) -> Column:
    return F.from_json(_whole(body), schema)


def quality(payload: Column) -> Column:
    """ok, no_result or undecodable, from a payload parsed with `CHECKED_PAYLOAD`."""
    return (
        F.when(payload["broken"].isNotNull(), UNDECODABLE)
        .when(F.coalesce(F.size(payload["result"]), F.lit(0)) > 0, OK)
        .otherwise(NO_RESULT)
    )


def parse_checked(body: Column) -> Column:
    """The payload, with the text in `broken` where it cannot be decoded."""
    return F.from_json(_whole(body), CHECKED_PAYLOAD, {"columnNameOfCorruptRecord": "broken"})


def cleaned_records(records: DataFrame, strip_ends: bool = False) -> DataFrame:
    """Drop line breaks from ids and contents, and blanks from ids. Columns besides those of a record come first."""
    others = [name for name in records.columns if name not in ("DocId", "Content", "JSON")]
    doc_id, content = clean_id(F.col("DocId")), without_line_breaks(F.col("Content"))
    if strip_ends:
        doc_id, content = strip(doc_id), strip(content)
    return records.select(*others, doc_id.alias("doc_id"), content.alias("content"), "JSON")


def record_quality(records: DataFrame, body_col: str = "JSON") -> DataFrame:
    """The quality of every record; `broken` holds the text of an undecodable one."""
    checked = let(
        parse_checked(F.col(body_col)),
        lambda payload: F.struct(quality(payload).alias("quality"), payload["broken"].alias("broken")),
    )
    others = [name for name in records.columns if name != body_col]
    return records.select(*others, checked.alias("_checked")).select(*others, "_checked.*")


def quarantine(records: DataFrame, body_col: str = "JSON") -> DataFrame:
    """Records whose payload could not be decoded, with the text that failed."""
    return record_quality(records, body_col).where(F.col("quality") == UNDECODABLE)


def corpus_lines(records: DataFrame, body_col: str = "JSON") -> DataFrame:
    """One line per document: its morphemes, or an empty line where the payload was undecodable.

    Documents without a result give no line.
    """

    def lines(payload: Column) -> Column:
        state = quality(payload)
        line = F.when(state == OK, corpus_line(F.get(payload["result"], F.lit(0))["kma"]))
        return F.when(state == NO_RESULT, F.array().cast("array<string>")).otherwise(
            F.array(F.coalesce(line, F.lit("")))
        )

    return records.select("doc_id", F.explode(let(parse_checked(F.col(body_col)), lines)).alias("line"))
