"""Row shapes of the text and JSON outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Where index documents go.
INDEX_NAME, INDEX_TYPE = "emotion", "analysis"


def index_document(doc_id: Column, source: dict[str, Column]) -> Column:
    """A JSON document for an index load."""
    body = F.struct(*[value.alias(name) for name, value in source.items()])
    return F.to_json(
        F.struct(
            F.lit(INDEX_NAME).alias("_index"), F.lit(INDEX_TYPE).alias("_type"), doc_id.alias("_id"),
            body.alias("_source"),
        )
    )


def joined_id(*parts: str | Column) -> Column:
    return F.concat_ws("_", *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts])


def tagged_record(doc_id: Column, date: str, content: Column, attributes: Sequence[Column]) -> Column:
    """One record of the tagged format: id, date and content marks, then the attributes between tabs."""
    return F.concat(
        F.lit("<DOCID>"), doc_id, F.lit(f"<DATE>{date}<CONTENT>"), content,
        F.concat_ws("\t", *[F.coalesce(a, F.lit("")) for a in attributes]),
    )


def wide_topics(rows: DataFrame, topics_col: str, n_topics: int) -> DataFrame:
    """Append `topic_1` … `topic_n` after the other columns; missing ones are null."""
    others = [name for name in rows.columns if name != topics_col]
    return rows.select(*others, *[F.get(topics_col, F.lit(i)).alias(f"topic_{i + 1}") for i in range(n_topics)])
