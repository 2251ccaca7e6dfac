"""Token counts of whole texts by merging all new pre-tokens of a block of texts together."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from docweave.llm import common
from docweave.llm.bpe import TokenCounter

LIMIT = 1024


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit of every row; null and empty texts count 0.

    `tokenizer` is the path of a byte-level BPE file. Counts are those of its library without added special tokens;
    its special strings inside a text count one each. Whole texts are counted, however long; repeated rows and null ids
    give a row each, an empty table none. Nothing is shuffled; a worker's table of chunks is bounded.
    """
    common.ship_package(docs.sparkSession)
    source = common.texts(docs, id_col, text_col)
    doc_id = source.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(tokenizer)
        for batch in common.blocks(batches):
            text = batch.column("text")
            n_tokens = pa.array(counter.counts(text.to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.binary_length(text).cast(pa.int64()), n_tokens, pc.greater(n_tokens, limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return source.mapInArrow(count, f"doc_id {doc_id}, n_bytes long, n_tokens long, over_limit boolean")
