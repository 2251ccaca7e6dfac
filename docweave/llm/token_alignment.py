"""Alignment of the tokens of two tokenizers by merge path, and how common each linked pair of tokens is.

Both tokenizers cut the same bytes, so an alignment is a merge of two sorted lists of byte ends. The ends of all texts of
a block form one pair of lists. Diagonals of equal distance cut their merge path into pieces of equal work: a binary
search on each diagonal finds how many ends of A and of B lie before it, whatever text they belong to. The pieces are
then independent and are merged side by side, one end of each piece per step. A piece emits a link for every stretch of
bytes between two ends, and a cut where both lists end; the cuts are numbered across the pieces, which stitches groups
that a diagonal has split.

Texts are encoded once. Distinct links of each text are written with how often it has them; counts per pair come from
that table and are joined back to it: pairs that many texts hold by a broadcast table of bounded size, the others, each
of which few texts hold, by a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docweave.llm import common
from docweave.llm.bpe import IdEncoder

#: Ends that a piece of the merge path holds.
PIECE = 128
#: Bytes of text that are worked on together, a longer text excepted.
BLOCK_BYTES = 1 << 19
#: A pair of ids is one number, the id of A above so many bits of the id of B.
B_BITS = 20
#: Pairs in the broadcast table, at most.
COMMON_PAIRS = common.SMALL_ROWS


class _A:
    """Ids and bytes of the byte-level tokenizer; strings of its special tokens are plain text."""

    def __init__(self, path: str):
        self.encoder = IdEncoder(path)
        self.encoder.cut = None
        size = max(self.encoder.vocab.ranks.values()) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in self.encoder.vocab.ranks.items():
            self.bytes[i] = token

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(self.encoder.ids(" " + text), "<u4").astype(np.int64) if text else _NONE for text in texts]


class _B:
    """Ids and bytes of the piece tokenizer: U+2581 stands for a space, <0xHH> for a byte."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        name = self.model.id_to_piece
        self.bytes = [
            bytes([int(name(i)[3:5], 16)]) if self.model.is_byte(i) else name(i).replace("▁", " ").encode()
            for i in range(self.model.get_piece_size())
        ]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


_NONE = np.empty(0, np.int64)


class Aligner:
    """Both tokenizers, the lengths of their tokens, and their ids as text with each separator that may follow."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = _A(path_a), _B(path_b)
        self.length_a = np.array([len(token) for token in self.a.bytes], np.int64)
        self.length_b = np.array([len(token) for token in self.b.bytes], np.int64)
        shown = [b"%d%c" % (i, sep) for i in range(len(self.a.bytes)) for sep in b",|"]
        shown += [b"%d%c" % (i, sep) for i in range(len(self.b.bytes)) for sep in b",;"]
        self.shown, self.first_b = np.array(shown, object), 2 * len(self.a.bytes)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B of each text; none where the bytes of either differ from the text after a space."""
        out = []
        for text, a, b in zip(texts, self.a.ids(texts), self.b.ids(texts)):
            raw = b" " + text.encode()
            whole = all(b"".join(map(side.bytes.__getitem__, ids.tolist())) == raw for side, ids in ((self.a, a), (self.b, b)))
            out.append((a, b) if text and whole else (_NONE, _NONE))
        return out


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def splits(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many ends of A lie before each diagonal of the merge path; at equal ends A comes first."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        first = a[np.minimum(middle, len(a) - 1)] <= b[np.clip(diagonals - 1 - middle, 0, len(b) - 1)]
        low = np.where(open_ & first, middle + 1, low)
        high = np.where(open_ & ~first, middle, high)
    return low


def merge_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (index in A, index in B), and the tokens of A and of B before the end of each group.

    `a` and `b` are the rising byte ends of two cuts of the same bytes. All pieces take a step at a time.
    """
    total = len(a) + len(b)
    starts = np.arange(0, total, piece)
    i = splits(a, b, starts)
    j = starts - i
    a, b = np.append(a, a[-1] + 1), np.append(b, b[-1] + 1)  # a guard after the last end
    before = np.maximum(np.where(i > 0, a[i - 1], 0), np.where(j > 0, b[j - 1], 0))
    at_i, at_j = np.empty((len(starts), piece), np.int64), np.empty((len(starts), piece), np.int64)
    linked, ended = np.zeros(at_i.shape, bool), np.zeros(at_i.shape, bool)
    for step in range(piece):
        n = len(starts) - (starts[-1] + step >= total)  # the last piece may be shorter
        i, j, before = i[:n], j[:n], before[:n]
        end_a, end_b = a[i], b[j]
        from_a = end_a <= end_b
        end = np.minimum(end_a, end_b)
        at_i[:n, step], at_j[:n, step] = i, j
        linked[:n, step] = end > before
        ended[:n, step] = (end == before) & ~from_a
        before = end
        i, j = i + from_a, j + ~from_a
    return at_i[linked], at_j[linked], at_i[ended], at_j[ended] + 1


def _block_rows(tools: Aligner, texts: list[str]) -> list[tuple]:
    """n_a, n_b, n_groups, n_links, groups_sha256, distinct pairs and how often each of every text."""
    encoded = tools.encode(texts)
    sizes_a = np.array([len(a) for a, _ in encoded], np.int64)
    sizes_b = np.array([len(b) for _, b in encoded], np.int64)
    if not sizes_a.any():
        return [(0, 0, 0, 0, "", [], [])] * len(texts)
    ids_a, ids_b = (np.concatenate(side) for side in zip(*encoded))
    link_a, link_b, cut_a, cut_b = merge_path(np.cumsum(tools.length_a[ids_a]), np.cumsum(tools.length_b[ids_b]))
    # Groups of a text: those whose end lies in it. Its last group ends with it.
    stop_a, stop_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    groups_to = np.searchsorted(cut_a, stop_a, "right")
    links_to = np.searchsorted(link_a, stop_a, "left")
    n_groups, n_links = np.diff(groups_to, prepend=0), np.diff(links_to, prepend=0)
    # Ids as text in the order of groups, those of A before those of B.
    group_a = np.repeat(np.arange(len(cut_a)), np.diff(cut_a, prepend=0))
    group_b = np.repeat(np.arange(len(cut_b)), np.diff(cut_b, prepend=0))
    codes = np.empty(len(ids_a) + len(ids_b), np.int64)
    shown_a, shown_b = 2 * ids_a, tools.first_b + 2 * ids_b
    shown_a[cut_a - 1] += 1
    shown_b[cut_b - 1] += 1
    codes[np.arange(len(ids_a)) + np.append(0, cut_b)[group_a]] = shown_a
    codes[np.arange(len(ids_b)) + cut_a[group_b]] = shown_b
    words = tools.shown[codes].tolist()
    # Distinct pairs of each text.
    owner = np.repeat(np.arange(len(texts)), n_links)
    keys = (owner << 40) | (ids_a[link_a] << B_BITS) | ids_b[link_b]
    distinct, times = np.unique(keys, return_counts=True)
    pairs = distinct & ((1 << 40) - 1)
    pairs_to = np.searchsorted(distinct, (np.arange(len(texts)) + 1) << 40)
    rows, word, pair = [], 0, 0
    for k in range(len(texts)):
        stop, last = int(stop_a[k] + stop_b[k]), int(pairs_to[k])
        digest = hashlib.sha256(b"".join(words[word:stop])[:-1]).hexdigest() if stop > word else ""
        rows.append((int(sizes_a[k]), int(sizes_b[k]), int(n_groups[k]), int(n_links[k]), digest, pairs[pair:last], times[pair:last]))
        word, pair = stop, last
    return rows


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    start, texts, size = 0, [], 0
    for row, text in enumerate(batch.column("text")):
        texts.append(text.as_py())
        size += len(texts[-1])
        if size >= BLOCK_BYTES:
            yield start, texts
            start, texts, size = row + 1, [], 0
    if texts:
        yield start, texts


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_no, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and the distinct pairs of each row with their times.

    A text is encoded by A after a space and by B, which adds that space itself. Rows whose text is null or empty, or
    not given back by both tokenizers byte for byte, have no tokens. A pair is the id of A * 2 ** B_BITS + that of B.
    """
    common.ship_package(docs.sparkSession)
    source = common.texts(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row_no"), "doc_id", "text")
    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    types = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = aligner(path_a, path_b)
        for batch in batches:
            for start, texts in _blocks(batch):
                columns = [pa.array(column, kind) for column, kind in zip(zip(*_block_rows(tools, texts)), types)]
                kept = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([kept.column("row_no"), kept.column("doc_id"), *columns], ["row_no", "doc_id", *names])

    doc_id = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        align, f"row_no long, doc_id {doc_id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<bigint>, times array<int>"
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n_docs (rows that hold the pair linked), and whether no pair of the same id of A has more."""
    counted = common.written(
        aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs")), "pairs"
    ).withColumn("a", F.shiftright("pair", B_BITS))
    most = counted.groupBy("a").agg(F.max("n_docs").alias("most"))
    return counted.join(common.small(most), "a").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("is_best"))


def token_alignment(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", common_pairs: int = COMMON_PAIRS
) -> DataFrame:
    """One row per document: tokens of A and B, groups, links, and how common its links are in all documents.

    n_best counts links whose pair is held by as many documents as any pair of the same id of A, ties included; count_sum
    adds up, over links, the documents that hold the link's pair. A link that a text has twice counts twice, and the text
    once. Repeated rows count as documents of their own, null ids too. Without tokens all numbers are 0 and
    groups_sha256 is ''. The result is the same for any `common_pairs`.
    """
    aligned = common.written(aligned_documents(docs, path_a, path_b, id_col, text_col), "aligned")
    counts = common.written(pair_counts(aligned), "pair-counts")
    # The least power of two such that at most `common_pairs` pairs are held by so many documents.
    held = counts.agg(*[F.count_if(F.col("n_docs") >= 2**k).alias(f"from_{k}") for k in range(63)]).first()
    floor = next((2**k for k in range(63) if held[k] <= common_pairs), 2**62)
    links = aligned.select("row_no", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    sums = [
        F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n_docs")).alias("count_sum"),
    ]
    frequent = F.broadcast(counts.where(F.col("n_docs") >= floor))
    found = links.join(frequent, "pair").groupBy("row_no").agg(*sums)
    if floor > 1:
        others = links.join(frequent, "pair", "left_anti").join(counts.where(F.col("n_docs") < floor), "pair")
        found = found.unionByName(others.groupBy("row_no").agg(*sums)).groupBy("row_no").agg(
            F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
        )
    return aligned.drop("pairs", "times").join(found, "row_no", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("bigint").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("bigint").alias("count_sum"), "groups_sha256",
    )
