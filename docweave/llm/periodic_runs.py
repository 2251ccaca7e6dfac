"""Periodic runs of words, found by minimizers at doubling scales.

A run is a maximal stretch of words in which words one period apart are identical. Periods up to `DIRECT` are found by
comparing all words with those `q` places on. For longer ones there is a scale for each doubling: scale `w` looks for
periods in (w, 2w]. Windows of `w` words repeat after one period inside a run, and so do the places of their least
hashes. Such a place is a seed: the fingerprint of the 2w words that start there is as long as the period at least, so
inside a run it comes back after exactly one period, never earlier. Each seed is therefore compared with the last
equal one only; pairs in (w, 2w] apart are extended to both sides by comparing the words themselves, which also decides
over any collision of hashes. Minima and fingerprints of a scale come from those of the scale before, so a scale costs a
few passes over the texts that are long enough for it.

All of it happens inside a row: nothing is shuffled, and a task holds the words of one block of texts at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docweave.llm import common

#: Periods up to this are found by direct comparison; scales begin here.
DIRECT = 8
#: A run holds its period at least so often, and so many words.
TIMES, LEAST = 4, 6
#: Bytes of text that are worked on together, a longer text excepted.
BLOCK_BYTES = 1 << 19

_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _primes(number: int) -> list[int]:
    found, divisor = [], 2
    while divisor * divisor <= number:
        if number % divisor == 0:
            found.append(divisor)
            while number % divisor == 0:
                number //= divisor
        divisor += 1
    return found + ([number] if number > 1 else [])


def _is_smallest(codes: np.ndarray, start: int, period: int) -> bool:
    """Whether a run with `period` has no smaller one. A smaller one would divide it, as the run is four periods long."""
    piece = codes[start : start + 2 * period]
    return not any(np.array_equal(piece[: -(period // p)], piece[period // p :]) for p in _primes(period))


def _same_ahead(codes: np.ndarray, left: int, right: int, end: int, step: int) -> int:
    """Words from `right` on, before `end`, that equal those from `left` on."""
    total, size = 0, end - right
    while total < size:
        take = min(step, size - total)
        differ = codes[left + total : left + total + take] != codes[right + total : right + total + take]
        if differ.any():
            return total + int(differ.argmax())
        total, step = total + take, 2 * step
    return total


def _same_behind(codes: np.ndarray, left: int, right: int, first: int, step: int) -> int:
    """Words before `left`, not before `first`, that equal those before `right`."""
    total, size = 0, left - first
    while total < size:
        take = min(step, size - total)
        differ = (codes[left - total - take : left - total] != codes[right - total - take : right - total])[::-1]
        if differ.any():
            return total + int(differ.argmax())
        total, step = total + take, 2 * step
    return total


def _short_runs(codes: np.ndarray, owner: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs with periods up to DIRECT. `owner` is the text of each word."""
    found = []
    for q in range(1, min(DIRECT, len(codes) - 1) + 1):
        same = np.concatenate([[False], (codes[q:] == codes[:-q]) & (owner[q:] == owner[:-q]), [False]])
        turns = np.flatnonzero(same[1:] != same[:-1])
        begin, stop = turns[::2], turns[1::2] + q
        long = stop - begin >= max(LEAST, TIMES * q)
        found += [(s, e, q) for s, e in zip(begin[long].tolist(), stop[long].tolist()) if q == 1 or _is_smallest(codes, s, q)]
    return found


def _seeds(least: np.ndarray, prints: np.ndarray, reach: int, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of window minima whose fingerprint, of `reach` words, comes again in the same text, and how far on."""
    places = (least & _U(0xFFFFFFFF)).astype(np.int64)
    places = places[np.append(True, places[1:] != places[:-1])]
    text = np.searchsorted(starts, places, "right") - 1
    inside = places + reach <= ends[text]
    places, text = places[inside], text[inside]
    order = np.lexsort((places, prints[places]))
    places, text, value = places[order], text[order], prints[places[order]]
    again = np.flatnonzero((value[1:] == value[:-1]) & (text[1:] == text[:-1])) + 1
    return places[again - 1], places[again] - places[again - 1]


def _long_runs(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs with periods above DIRECT, in texts given by their bounds."""
    found, offset, w = [], np.zeros(len(starts), np.int64), DIRECT
    least = prints = None
    while (long := ends - starts >= TIMES * (w + 1)).any():
        sizes = (ends - starts)[long]
        if sizes.sum() < 0.7 * len(codes):  # go on with the texts that are long enough
            codes = codes[np.repeat(long, ends - starts)]
            offset = offset[long] + starts[long]
            ends = np.cumsum(sizes)
            starts = ends - sizes
            offset -= starts
            least = None
        if least is None:
            prints, width = _mixed(codes.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(1)), 1
            # The least hash of the windows of `span` words, with its place; the leftmost wins a tie.
            least, span = (prints & _U(0xFFFFFFFF00000000)) | np.arange(len(codes), dtype=_U), 1
        while span < w:
            least, span = np.minimum(least[:-span], least[span:]), 2 * span
        while width < 2 * w:
            prints, width = _mixed(prints[:-width] * _U(0xC2B2AE3D27D4EB4F) + _mixed(prints[width:] + _U(width))), 2 * width
        before, lag = _seeds(least, prints, 2 * w, starts, ends)
        near = (lag > w) & (lag <= 2 * w)
        before, lag = before[near], lag[near]
        order = np.lexsort((before, lag))
        done_lag, done_to = 0, -1
        text = np.searchsorted(starts, before, "right") - 1
        for i in order.tolist():
            place, q = int(before[i]), int(lag[i])
            if q == done_lag and place + q <= done_to:
                continue  # inside the stretch that was looked at last
            first, last = int(starts[text[i]]), int(ends[text[i]])
            right = place + q
            stop = right + _same_ahead(codes, place, right, last, 4 * w)
            start = place - _same_behind(codes, place, right, first, 4 * w)
            done_lag, done_to = q, stop
            if stop - start >= max(LEAST, TIMES * q) and _is_smallest(codes, start, q):
                found.append((start + int(offset[text[i]]), stop + int(offset[text[i]]), q))
        w *= 2
    return found


def find_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each text, by start and period."""
    known: dict[bytes, int] = {}
    codes = np.array([known.setdefault(word, len(known)) for words in texts for word in words], np.int64)
    sizes = np.array([len(words) for words in texts], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    some = np.flatnonzero(sizes)
    if len(codes) >= LEAST:
        all_runs = _short_runs(codes, np.repeat(np.arange(len(texts)), sizes))
        all_runs += _long_runs(codes, starts[some], ends[some])
        for start, stop, period in all_runs:
            text = some[int(np.searchsorted(starts[some], start, "right")) - 1]
            runs[text].append((start - int(starts[text]), stop - start, period))
    return [sorted(found, key=lambda run: (run[0], run[2])) for found in runs]


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; then the smallest start and period."""
    best = None
    for start, length, period in runs:  # by start and period
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]


def with_planted_run(words: list[bytes], doc_id: object) -> list[bytes]:
    """The words, in every tenth document by the checksum of its id with a run that begins at a place and has a period of its own."""
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a + i % p] for i in range(n - a))]


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and words of a batch, in blocks of bounded bytes."""
    ids, words, size = [], [], 0
    for doc_id, text in zip(batch.column("doc_id"), batch.column("text").cast(pa.large_binary())):
        raw = text.as_py()
        ids.append(doc_id.as_py())
        words.append(raw.split())  # of bytes: at blank, \t, \n, \v, \f and \r only
        size += len(raw)
        if size >= BLOCK_BYTES:
            yield ids, words
            ids, words, size = [], [], 0
    if ids:
        yield ids, words


def periodic_runs(docs: DataFrame, planted: bool = False, id_col: str = "doc_id", text_col: str = "text", with_runs: bool = False) -> DataFrame:
    """One row per document: n_runs, its best run, and digests of all runs and of the text without repetitions.

    Best is the run with the greatest length / period, then the smallest start and period; start, length, period and
    exponent_milli are null where there is no run. Runs may overlap. `planted` first repeats words of every tenth document
    (`with_planted_run`). `with_runs` adds all runs (start, length, period) and the collapsed text. Null, empty and blank
    texts have no words and no runs; ids may be null or repeated, each row is judged by itself; a long text is one block.
    """
    common.ship_package(docs.sparkSession)
    source = common.texts(docs, id_col, text_col)
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    types = [pa.int64()] * 5 + [pa.string()] * 2
    fields = ", ".join(f"{name} {'string' if name.endswith('sha256') else 'long'}" for name in names)
    if with_runs:
        names, types = [*names, "runs", "collapsed"], [*types, pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])), pa.string()]
        fields += ", runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for ids, texts in _blocks(batch):
                if planted:
                    texts = [with_planted_run(words, doc_id) for doc_id, words in zip(ids, texts)]
                out = []
                for words, runs in zip(texts, find_runs(texts)):
                    best = best_run(runs) or (None, None, None)
                    exponent = best[1] * 1000 // best[2] if runs else None
                    listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs).encode()
                    text = b" ".join(collapsed(words, runs))
                    row = (len(runs), *best, exponent, hashlib.sha256(listed).hexdigest(), hashlib.sha256(text).hexdigest())
                    if with_runs:
                        row += ([dict(zip(("start", "length", "period"), run)) for run in runs], text.decode())
                    out.append(row)
                columns = [pa.array(column, kind) for column, kind in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), *columns], ["doc_id", *names])

    return source.mapInArrow(rows, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {fields}")
