"""The corpus pipeline: toxic documents, exact copies, near copies, secrets, packing.

Every stage but the last takes and returns rows with the columns of `documents`. Between stages the rows are written as
Parquet to the shared folder, so a lost executor costs no earlier stage.

All stages read whole texts, however long, take an empty table and give an empty one, and leave columns besides the text
alone, null or not, whatever else their names are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docweave.llm import common
from docweave.llm.exact_dedup import drop_copies
from docweave.llm.near_dedup import drop_near_copies
from docweave.llm.packing import pack_documents
from docweave.llm.secrets import learn_limits, redact
from docweave.llm.toxicity import drop_toxic, train

TOKENIZER = "byte_bpe_50k.json"
#: Words of a shingle for near copies.
SHINGLE_WORDS = 5


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more by a model that learns from the labels of `sf_dir` go.

    Null and empty texts are scored by zeros, equal texts alike; repeated rows stay or go together.
    """
    return drop_toxic(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays; null texts count as empty ones, null ids come last.

    Of repeated rows with the same id the one that lies last stays.
    """
    return drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id stays, of repeated ids the row that lies first.

    Texts without words are near nothing and stay; null ids come last.
    """
    return drop_near_copies(docs, SHINGLE_WORDS)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in them are replaced by a mark. Null texts stay null."""
    return redact(docs, learn_limits(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences; null and empty texts are one piece of one id.

    Which of equally long pieces share a sequence may differ between runs, the number of sequences does not depend on it.
    """
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("minhash_near_dedup", near_stage),
    ("secret_scans", secrets_stage),
    ("best_fit_packing", packing_stage),
]
#: The trained filter has no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents of `sf_dir`."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
