"""Removal of repeated passages by level-wise doubling.

Every window of `window` words holds one chosen short window (the least by hash of those inside it); equal windows choose
at the same place. Chosen short windows that occur once are dropped; those that are repeated are extended to twice the
length, to the left and to the right, and counted again, until the length reaches `window` or nothing survives. At the
last length all windows around the survivors are compared by 96 bits of hash, and each is traced to its first start.
Copies of a whole document are found beforehand by their digest: none of their windows starts first.

With the defaults, 10 words to 20, there is a single doubling: all windows around the repeated short windows are compared
at once, and no level lies between. Short windows of 5 words, with one level more, were stopped by the disk limit of the
check. The result does not depend on the base; tests run more levels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from docweave.llm import common
from docweave.llm.exact_dedup import located

WINDOW = 20
#: Length of the chosen short windows; doubled once or more it is at most WINDOW. A smaller one means more levels, and
#: more short windows that are repeated by chance.
BASE = 10

_U = np.uint64
_LANES = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHasher:
    """64-bit hashes of words, kept in a bounded table."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > 300_000:
            known.clear()
        out = []
        for word in words:
            value = known.get(word)
            if value is None:
                value = known[word] = xxhash.xxh3_64_intdigest(word)
            out.append(value)
        return np.array(out, _U)


def window_hashes(words: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """Hash of every window of `length` word hashes."""
    n = len(words) - length + 1
    if n < 1:
        return np.zeros(0, _U)
    total = words[:n].copy()
    for i in range(1, length):
        total = total * _LANES[lane] + words[i : i + n]
    return _mixed(total)


def chosen(hashes: np.ndarray, span: int) -> np.ndarray:
    """Places of the least hash in every stretch of `span` hashes, the first of equal ones."""
    if len(hashes) < span:
        return np.zeros(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(hashes, span).argmin(axis=1)
    return np.unique(least + np.arange(len(least)))


def _read(source: DataFrame, window: int, base: int) -> DataFrame:
    """row, doc_id, _file, _row, n_words, sha256 (of the words joined by one space), hashes and places of chosen windows."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, row = WordHasher(), TaskContext.get().partitionId() << 36
        for batch in common.blocks(batches):
            n_words, digests, hashes, places = [], [], [], []
            for text in batch.column("text").to_pylist():
                words = text.encode().split()
                n_words.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).digest())
                short = window_hashes(hasher(words), base)
                at = chosen(short, window - base + 1)
                hashes.append(short[at].view(np.int64))
                places.append(at.astype(np.int32))
            rows = pa.array(np.arange(row, row + len(n_words)))
            row += len(n_words)
            columns = [
                rows, *(batch.column(c) for c in ("doc_id", "_file", "_row")), pa.array(n_words, pa.int64()), pa.array(digests),
                pa.array(hashes, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "_file", "_row", "n_words", "sha256", "hashes", "places"])

    doc_id = source.schema["doc_id"].dataType.simpleString()
    fields = f"row long, doc_id {doc_id}, _file string, _row long, n_words long, sha256 binary, hashes array<long>, places array<int>"
    return source.mapInArrow(read, fields)


def _in_order(rows: DataFrame) -> DataFrame:
    """(row, rank): ranks rise with doc_id, null ids last, rows of one id as they lie."""
    keys = [F.col("doc_id").isNull(), "doc_id", "row"]
    ranged = rows.select("row", "doc_id").repartitionByRange(*keys).sortWithinPartitions(*keys)
    return common.written(ranged.select("row", F.monotonically_increasing_id().alias("rank")), "ranks")


def _repeated(windows: DataFrame) -> DataFrame:
    """(rank, at) of the windows (h, rank, at) whose hash occurs twice or more."""
    twice = windows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    return windows.join(common.written(twice, "repeated"), "h", "left_semi").select("rank", "at")


def _extended(texts: DataFrame, length: int) -> DataFrame:
    """Windows (h, rank, at) of twice `length`, to the left and to the right of those at `ats`."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in common.blocks(batches):
            out = [[], [], []]
            for rank, text, ats in zip(*(batch.column(c).to_pylist() for c in ("rank", "text", "ats"))):
                hashes = window_hashes(hasher(text.encode().split()), 2 * length)
                at = np.array(ats, np.int64)
                at = np.unique(np.concatenate([at, at - length]))
                at = at[(at >= 0) & (at < len(hashes))]
                for column, values in zip(out, (hashes[at].view(np.int64), np.full(len(at), rank), at)):
                    column.append(values)
            columns = [pa.array(np.concatenate(values) if values else [], kind) for values, kind in zip(out, (pa.int64(), pa.int64(), pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["h", "rank", "at"])

    return texts.select("rank", "text", "ats").mapInArrow(extend, "h long, rank long, at int")


def _whole(texts: DataFrame, length: int, window: int) -> DataFrame:
    """Windows of `window` words that hold a window of `length` at `ats`: 96 bits of hash, rank, start, and whether the
    same window starts earlier in the document."""

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in common.blocks(batches):
            firsts, seconds, ranks, starts, again = [], [], [], [], []
            for rank, text, ats in zip(*(batch.column(c).to_pylist() for c in ("rank", "text", "ats"))):
                words = hasher(text.encode().split())
                n = len(words) - window + 1
                if n < 1:
                    continue
                edges = np.zeros(n + 1, np.int64)
                at = np.array(ats, np.int64)
                np.add.at(edges, np.clip(at - (window - length), 0, n), 1)
                np.add.at(edges, np.clip(at + 1, 0, n), -1)
                own = np.flatnonzero(np.cumsum(edges[:-1]))
                one, two = window_hashes(words, window)[own], window_hashes(words, window, 1)[own]
                if not len(own):
                    continue
                order = np.lexsort((own, two, one))
                one, two, own = one[order], two[order], own[order]
                firsts.append(one.view(np.int64))
                seconds.append((two >> _U(32)).astype(np.uint32).view(np.int32))
                ranks.append(np.full(len(own), rank))
                starts.append(own.astype(np.int32))
                again.append(np.append(False, (one[1:] == one[:-1]) & (two[1:] == two[:-1])))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_())
            columns = [pa.array(np.concatenate(part) if part else [], kind) for part, kind in zip((firsts, seconds, ranks, starts, again), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "rank", "start", "again"])

    return texts.select("rank", "text", "ats").mapInArrow(cover, "h1 long, h2 int, rank long, start int, again boolean")


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """rank, n_removed, sha256 of the kept words, removed spans, from the starts of removed windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.blocks(batches):
            n_removed, digests, spans = [], [], []
            for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist()):
                words = text.encode().split()
                edges = np.zeros(len(words) + 1, np.int64)
                np.add.at(edges, np.array(starts, np.int64), 1)
                np.add.at(edges, np.array(starts, np.int64) + window, -1)
                gone = np.cumsum(edges[:-1]) > 0
                n_removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(b" ".join(word for word, out in zip(words, gone.tolist()) if not out)).digest())
                turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            columns = [batch.column("rank"), pa.array(n_removed, pa.int64()), pa.array(digests, pa.binary()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["rank", "n_removed", "kept", "spans"])

    return texts.select("rank", "text", "starts").mapInArrow(cut, "rank long, n_removed long, kept binary, spans array<struct<start:int,end:int>>")


def substring_dedup(docs: DataFrame, window: int = WINDOW, base: int = BASE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, kept_sha256, spans (word places of what is removed).

    Words are runs without ASCII white space, unchanged. A word is removed if a window of `window` words that covers it
    also starts earlier: in a document of a smaller id, or earlier in its own. Null ids come after all others; rows of
    one id count in the order in which they lie. Null and empty texts have no words. `base` doubled once or more must be
    at most `window`.
    """
    if not 0 < 2 * base <= window:
        raise ValueError("base doubled must be at most window")
    common.ship_package(docs.sparkSession)
    with common.temporary_tables(docs.sparkSession):
        return _deduplicated(docs, window, base, id_col, text_col)


def _deduplicated(docs: DataFrame, window: int, base: int, id_col: str, text_col: str) -> DataFrame:
    source = located(docs).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), "_file", "_row")
    read = common.written(_read(source, window, base), "words")
    rows = read.join(_in_order(read), "row").select("rank", "doc_id", "_file", "_row", "n_words", "sha256", "row")
    rows = common.written(rows, "rows", keep=True)
    firsts = rows.where(F.col("n_words") >= window).groupBy("sha256").agg(F.min("rank").alias("rank"))
    firsts = common.written(firsts.join(rows.select("rank", "_file", "_row", "row"), "rank"), "firsts", keep=True)

    windows = read.select("row", "hashes", "places").join(common.small(firsts.select("row", "rank")), "row").select(
        "rank", F.explode(F.arrays_zip("hashes", "places")).alias("w")
    ).select(F.col("w.hashes").alias("h"), "rank", F.col("w.places").alias("at"))
    length, texts = base, None
    while True:
        survivors = _repeated(windows).groupBy("rank").agg(F.collect_list("at").alias("ats"))
        survivors = common.written(survivors, f"survivors-{length}")
        if texts is None:
            places = survivors.select("rank").join(firsts, "rank").select("rank", F.col("_file").alias("its_file"), F.col("_row").alias("its_row"))
            places = common.written(places, "places")
            here = (F.col("_file") == F.col("its_file")) & (F.col("_row") == F.col("its_row"))
            texts = common.written(source.join(common.small(places), here).select("rank", "text"), "candidate-texts")
        candidates = texts.join(survivors, "rank")
        if 4 * length > window:
            break
        windows = common.written(_extended(candidates, length), f"windows-{2 * length}")
        length *= 2

    whole = common.written(_whole(candidates, length, window), "whole-windows")
    heads = whole.where("NOT again")
    shared = heads.groupBy("h1", "h2").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = common.written(shared.select("h1", "h2", "first"), "shared")
    later = heads.join(shared, ["h1", "h2"]).where("rank > first").select("rank", "start")
    removed = later.unionByName(whole.where("again").select("rank", "start")).groupBy("rank").agg(F.collect_list("start").alias("starts"))
    removed = common.written(removed, "removed")
    cut = common.written(_cut(texts.join(removed, "rank"), window), "cut", keep=True)

    copies = rows.join(firsts.select("sha256", F.col("rank").alias("first")), "sha256", "left")
    is_copy = F.col("first").isNotNull() & (F.col("rank") > F.col("first"))
    all_of_it = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    digest = F.when(is_copy, F.sha2(F.lit(""), 256)).otherwise(F.lower(F.hex(F.coalesce("kept", "sha256"))))
    return copies.join(cut, "rank", "left").select(
        "doc_id", "n_words", F.when(is_copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        digest.alias("kept_sha256"), F.when(is_copy, all_of_it).otherwise(F.coalesce("spans", none)).alias("spans"),
    )
