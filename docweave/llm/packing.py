"""Best-fit packing of token pieces, certified by lower bounds.

Pieces are dealt evenly over groups. Each group is packed best-fit decreasing and compared with the largest bound that
dual-feasible functions give for its lengths. A group that needs more sequences than its bound has a gap: it keeps the
sequences it has filled and exchanges the documents of the others with the other groups in the next round, where they
are packed anew. Rounds end when no group has a gap worth another round. A group's task holds a bounded number of
lengths, never the texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from docweave.llm import common
from docweave.llm.bpe import IdEncoder

CAPACITY = 1024
#: The id that ends a document.
END = 2
#: Pieces of a group in the first round; later rounds take four times as many, up to MOST_ITEMS.
GROUP_ITEMS = 8_192
MOST_ITEMS = 131_072
ROUNDS = 4
_PLACE = T.StructType().add("sequence_id", "long").add("offset", "long").add("_again", "boolean")



def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """The pieces of every document: its ids and END, cut from the end into pieces of `capacity` if longer.

    doc_id, piece (from 0), start (ids before it), length, ids_crc32. Only the first piece may be shorter. Null and
    empty texts give one piece of one id. `with_ids` adds `ids` as little-endian unsigned 32-bit numbers.
    """
    common.ship_package(docs.sparkSession)
    source = common.texts(docs, id_col, text_col)
    doc_id = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, "
    names = ["piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = IdEncoder(tokenizer), np.array([END], "<u4").tobytes()
        for batch in common.blocks(batches):
            owners, rows = [], []
            for owner, text in enumerate(batch.column("text").to_pylist()):
                ids = encoder.ids(text) + end
                total = len(ids) // 4
                bounds = [0, *range(total % capacity or capacity, total + 1, capacity)]
                for piece, (start, stop) in enumerate(zip(bounds, bounds[1:])):
                    own = ids[4 * start : 4 * stop]
                    owners.append(owner)
                    rows.append((piece, start, stop - start, zlib.crc32(own), own)[: len(names)])
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(owners)), *columns], ["doc_id", *names])

    fields = "piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return source.mapInArrow(cut, doc_id + fields)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the load of each bin. Each item goes to the fullest bin that holds it."""
    bins, offsets, loads = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    free_set = 0  # bit f: a bin with f free places exists
    order = np.argsort(-lengths, kind="stable")
    for item, length in zip(order.tolist(), lengths[order].tolist()):
        fitting = free_set >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            which = by_free[free].pop()
            if not by_free[free]:
                free_set &= ~(1 << free)
        else:
            which, free = len(loads), capacity
            loads.append(0)
        bins[item], offsets[item] = which, loads[which]
        loads[which] += length
        left = free - length
        if left:
            by_free[left].append(which)
            free_set |= 1 << left
    return bins, offsets, np.array(loads, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: the best of the volume bound and two families of dual-feasible functions.

    The first takes lengths above capacity - k as whole, those below k as nothing. The second rounds
    (k + 1) * length / capacity down unless it is whole.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    number, volume = np.cumsum(count), np.cumsum(count * size)
    k = np.arange(1, capacity // 2 + 1)
    whole = number[-1] - number[capacity - k]
    middle = volume[capacity - k] - volume[k - 1]
    best = max(int(-(-volume[-1] // capacity)), int((whole + -(-middle // capacity)).max()))
    for k in range(1, 101):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, k * size, (scaled // capacity) * capacity)  # in units of 1 / (k * capacity)
        best = max(best, int(-(-(count * value).sum() // (k * capacity))))
    return best


def _pack_group(table: pa.Table, capacity: int, number: int, last: bool) -> pa.Table:
    """Sequence and offset of each piece of one group, and whether its sequence goes to the next round.

    A certified group keeps all sequences but one that is less than half full; a group with a gap keeps its full ones.
    """
    lengths = table.column("length").to_numpy().astype(np.int64)
    bins, offsets, loads = best_fit_decreasing(lengths, capacity)
    again = np.zeros(len(loads), bool)
    if not last:
        if len(loads) > lower_bound(lengths, capacity):
            again = loads < capacity
        else:
            emptiest = int(loads.argmin())
            again[emptiest] = 2 * loads[emptiest] < capacity
    group = table.column("_group")[0].as_py()
    sequence = (number << 58) | (group << 20) | bins
    keep = table.drop_columns(["_group"])
    return keep.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offsets)).append_column("_again", pa.array(again[bins]))


def _packer(capacity: int, number: int, last: bool) -> Callable[[pa.Table], pa.Table]:
    return lambda table: _pack_group(table, capacity, number, last)


def pack(items: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, rounds: int = ROUNDS) -> DataFrame:
    """`items` (with `length`, 1 to `capacity`) with sequence_id and offset: no sequence is longer than `capacity`.

    Every row is placed once, repeated rows too; an empty table stays empty. Items of equal length, and bins that are
    equally full, are interchangeable: which is taken may differ between runs, the number of sequences does not depend
    on it. Other columns, null or not, are carried along. `items` should be a written table, so that
    a lost task deals its rows to the same groups again. A round that saves no sequence is not used.
    """
    common.ship_package(items.sparkSession)
    columns = [c for c in items.columns if c not in ("sequence_id", "offset")]
    pool, before, parts = items.select(*columns), None, []
    for number in range(rounds):
        n = pool.count()
        size = min(MOST_ITEMS, group_items * 4**number)
        groups = max(1, ceil(n / size))
        dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(number)), F.lit(groups))
        schema = T.StructType([*pool.select(*columns).schema.fields, *_PLACE.fields])
        last = number == rounds - 1
        packed = pool.select(*columns).withColumn("_group", dealt).groupBy("_group").applyInArrow(
            _packer(capacity, number, last), schema
        )
        packed = common.written(packed, f"packed-{number}")
        counts = packed.agg(
            F.count_if(F.col("offset") == 0).alias("used"), F.count_if(F.col("_again") & (F.col("offset") == 0)).alias("open")
        ).first()
        if before is not None and counts.used >= before:
            parts.append(pool.select(*columns, "sequence_id", "offset"))
            break
        parts.append(packed.where(~F.col("_again")).select(*columns, "sequence_id", "offset"))
        if not counts.open:
            break
        pool, before = packed.where("_again"), counts.open
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its sequence and offset.

    Null and empty texts are one piece of one id, a long text is as many pieces as it needs; repeated rows are documents
    of their own, and an empty table gives no pieces.
    """
    return pack(common.written(pieces(docs, tokenizer, capacity, id_col, text_col), "pieces"), capacity)


def sequences(packed_with_ids: DataFrame) -> DataFrame:
    """The packed ids: sequence_id, n_ids, ids (little-endian unsigned 32-bit numbers) of each sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda out, part: F.concat(out, part["ids"]))
    return packed_with_ids.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), joined.alias("ids"))
