"""Small dictionaries as literals, and other helpers for lookups inside a row."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row for a body that uses it several times, for example inside a lambda.

    The only element is taken out as the largest one: taken by its place, the type of the body is worked out for each row.
    The body's type must have an order, as all but maps have.
    """
    return F.array_max(F.transform(F.array(value), body))


# Entries of a bucket on average: a map is searched from its first entry on.
BUCKET_ENTRIES = 2


def literal_buckets(entries: Mapping[str, object], value_type: str) -> tuple[Column, int]:
    """Map literals by crc32 of the key, and their number; Catalyst folds the parsing away when it plans the query."""
    n = max(1, len(entries) // BUCKET_ENTRIES)
    buckets: list[dict] = [{} for _ in range(n)]
    for key, value in entries.items():
        buckets[zlib.crc32(key.encode()) % n][key] = value
    return F.from_json(F.lit(json.dumps(buckets, ensure_ascii=False)), f"array<map<string,{value_type}>>"), n


def lookup(key: Column, entries: Mapping[str, object], value_type: str, default: Column) -> Column:
    """Value of `key`. Membership is a hash test and a hit searches one bucket, so large dictionaries cost the same."""
    if not entries:
        return default
    buckets, n = literal_buckets(entries, value_type)
    found = F.element_at(F.get(buckets, (F.crc32(key.cast("binary")) % n).cast("int")), key)
    return F.when(key.isin(list(entries)), found).otherwise(default)


# Numbers that are summed up in one growing array.
SUM_BLOCK = 128


def sums_before(lengths: Column) -> Column:
    """Sums of all numbers before each place, in blocks: an array that grows step by step is copied in every step.

    Few numbers are summed up at once.
    """

    def running(values: Column, first: Column) -> Column:
        return F.aggregate(values, F.array(first), lambda sums, value: F.array_append(sums, F.element_at(sums, -1) + value))

    def of_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda total, value: total + value))
        return let(
            running(totals, F.lit(0)),
            lambda firsts: F.flatten(
                F.transform(blocks, lambda block, b: F.slice(running(block, F.get(firsts, b)), 1, F.size(block)))
            ),
        )

    def at_once(values: Column) -> Column:
        return F.slice(running(values, F.lit(0)), F.lit(1), F.size(values))

    def cut(values: Column) -> Column:
        n_blocks = F.ceil(F.size(values) / SUM_BLOCK).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), F.greatest(n_blocks - 1, F.lit(0))), lambda b: F.slice(values, b * SUM_BLOCK + 1, SUM_BLOCK)
        )
        return let(blocks, of_blocks)

    return let(lengths, lambda values: F.when(F.size(values) <= SUM_BLOCK, at_once(values)).otherwise(cut(values)))
