"""Quality scores of whole texts: statistics of the document, boosted trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docweave.llm import boosting, common
from docweave.llm.labelled import training_rows

#: Labelled rows the trees learn from, at most.
SAMPLE_ROWS = 20_000
FOLDS = 5
THRESHOLD = 0.3
STATISTICS = (
    "words", "word_length", "longest_word", "symbols", "capitals", "exclamations", "digits", "punctuation", "bars",
    "other_bytes", "distinct_words", "most_common_word", "repeated_pairs", "repeated_triples", "stuttered_words", "line_words",
    "repeated_lines", "ends_of_lines", "short_words", "symbol_words",
)


def statistics(text: str) -> list[float]:
    """STATISTICS of a whole text, as shares wherever they would grow with its length; zeros if it has no words."""
    raw = text.encode()
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * len(STATISTICS)
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lengths = np.fromiter(map(len, words), np.int64, n)
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(word, len(index)) for word in words), np.int64, n)
    uses = np.bincount(ids)
    pairs = ids[:-1] * len(index) + ids[1:]
    triples = (ids[:-2] * len(index) + ids[1:-1]) * len(index) + ids[2:]
    lines = [line for line in raw.split(b"\n") if line.strip()]
    total = lambda characters: float(bytes_[np.frombuffer(characters, np.uint8)].sum()) / size
    share = lambda part, whole: float(part) / max(1, whole)
    return [
        float(np.log1p(n)), float(lengths.mean()), float(np.log1p(lengths.max())), total(b"#*$%&<>"),
        float(bytes_[65:91].sum()) / size, total(b"!"), float(bytes_[48:58].sum()) / size, total(b".,;:?-'\""), total(b"|"),
        float(bytes_[128:].sum()) / size, share(len(index), n), share(uses.max(), n),
        1 - share(len(np.unique(pairs)), len(pairs)) if n > 1 else 0.0,
        1 - share(len(np.unique(triples)), len(triples)) if n > 2 else 0.0,
        share((ids[1:] == ids[:-1]).sum(), n), float(np.log1p(n / len(lines))), 1 - share(len(set(lines)), len(lines)),
        share(sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines), len(lines)), share((lengths <= 2).sum(), n),
        share(sum(word[-1:] in b"#*$%&!|" for word in index), len(index)),
    ]


def matrix(texts: list[str]) -> np.ndarray:
    return np.array([statistics(text) for text in texts], np.float64).reshape(len(texts), len(STATISTICS))


def fold(column: str = "doc_id") -> Column:
    """Rows of fold 0 are held out."""
    return common.id_crc32(column) % FOLDS


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, label: str = "quality") -> boosting.Trees:
    """Trees from a bounded sample of labels outside the held-out fold. Only statistics and labels reach the driver."""
    common.ship_package(docs.sparkSession)
    rows = training_rows(docs, labels, label, fold() != 0, sample_rows).select("label", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.blocks(batches):
            values = pa.array(matrix(batch.column("text").to_pylist()).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("label"), values], ["label", "x"])

    found = rows.mapInArrow(measure, "label int, x array<double>").toPandas()
    if not len(found):
        return boosting.constant(0.5, len(STATISTICS))
    order = np.lexsort(np.array(found["x"].tolist()).T)  # the order of rows must not matter
    return boosting.fit(np.array(found["x"].tolist())[order], found["label"].to_numpy()[order])


def quality_scores(docs: DataFrame, model: boosting.Trees, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted of every row.

    Null and empty texts are scored by their statistics, which are zeros; a long text is read whole. Rows are scored by
    their text alone, so equal texts have equal scores, and repeated rows and null ids one row each. The model is a few
    arrays of fixed size.
    """
    common.ship_package(docs.sparkSession)
    source = common.texts(docs, id_col, text_col).select("doc_id", (fold() == 0).alias("held_out"), "text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.blocks(batches):
            scores = model.score(matrix(batch.column("text").to_pylist()))
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    doc_id = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(score, f"doc_id {doc_id}, held_out boolean, score double, predicted int")
