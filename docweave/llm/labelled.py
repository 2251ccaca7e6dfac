"""The bounded sample of labelled rows that classifiers learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docweave.llm import common


def training_rows(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, most: int) -> DataFrame:
    """(doc_id, text, label) of at most `most` labelled documents that `allowed` lets in, chosen by a hash of the id.

    The ids are at most `most` rows and are therefore broadcast. Labels or ids that are null are left out; of repeated
    labels and documents the largest counts.
    """
    chosen = (
        labels.where(allowed & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    return (
        common.texts(docs).join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id").agg(F.max("text").alias("text"), F.first("label").alias("label"))
    )
