"""SentencePiece encoding by N-best segmentation, and decoding.

The segmentations of a text are the paths through the lattice of pieces; a path is worth the sum of its pieces' scores.
Viterbi scores from the left are exact for what lies before a place, so an A* search from the right pops the paths from
the best on and looks at nothing else. No piece goes on over a word mark, so the lattice of a text falls into those of
its words: words are searched once, and the best paths of the text differ from the best one in few words.
"""

from __future__ import annotations

import heapq
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docweave.llm import common

MARK = "▁"
#: What a byte of a character without a piece is worth below the least score.
BYTE_PENALTY = 10.0
#: Words kept by one Python worker; words up to SHORT characters are searched BLOCK at a time. Both ways of searching
#: take the longer last piece where scores are equal.
MEMO_WORDS, SHORT, BLOCK = 400_000, 40, 4_096

_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
Path = tuple[float, tuple[int, ...]]


_FACTOR = 0x9E3779B97F4A7C15


def _key(piece: str) -> int:
    """64-bit key of a string, one character after the other."""
    key = 0
    for character in piece:
        key = (key * _FACTOR + ord(character) + 1) % 2**64
    return key


class PieceModel:
    """Pieces, scores and byte ids of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.text, self.ids, self.scores, self.bytes = [], {}, {}, {}
        for i in range(library.get_piece_size()):
            piece = library.id_to_piece(i)
            self.text.append(piece)
            if library.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i)):
                self.ids[piece], self.scores[piece] = i, library.get_score(i)
        values = {i: value for value, i in self.bytes.items()}
        self.raw = [bytes([values[i]]) if i in values else piece.encode() for i, piece in enumerate(self.text)]
        self.longest = max(map(len, self.ids))
        self.byte_score = min(score for score in self.scores.values() if score > -1e8) - BYTE_PENALTY
        keys = np.array([_key(piece) for piece in self.ids], np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(list(self.ids.values()), np.int64)[order]
        self.key_scores = np.array(list(self.scores.values()))[order]
        begins = {_key(piece[:end]) for piece in self.ids for end in range(1, len(piece) + 1)}
        self.begins = np.array(sorted(begins), np.uint64)
        if len(np.unique(keys)) < len(keys) or any(MARK in piece.lstrip(MARK) for piece in self.ids):
            raise ValueError("a piece goes on over a word mark, or two pieces have the same key")

    def normalized(self, text: str) -> str:
        """Spaces as marks, and one more in front of a text that is not empty."""
        return (MARK + text).replace(" ", MARK) if text else ""

    def arcs(self, word: str) -> list[tuple[int, int, float]]:
        """Pieces in `word` as (start, end, score), by start. A character without a piece is an arc of its bytes."""
        out, scores, size, longest = [], self.scores, len(word), self.longest
        for start in range(size):
            if word[start] not in scores:
                out.append((start, start + 1, self.byte_score * len(word[start].encode())))
            for end in range(start + 1, min(size, start + longest) + 1):
                score = scores.get(word[start:end])
                if score is not None:
                    out.append((start, end, score))
        return out

    def arc_ids(self, piece: str) -> tuple[int, ...]:
        own = self.ids.get(piece)
        return (own,) if own is not None else tuple(self.bytes[b] for b in piece.encode())

    def best(self, word: str) -> tuple[float, tuple[int, ...], float]:
        """Score and ids of the best path of a word, and what the second path loses (infinite if there is none).

        The best path through an arc is worth its Viterbi scores from both sides; the second path has an arc that the
        best one lacks.
        """
        worst, size, arcs = float("-inf"), len(word), self.arcs(word)
        left, right, back = [0.0] + [worst] * size, [worst] * size + [0.0], [0] * (size + 1)
        for start, end, score in arcs:
            value = left[start] + score
            if value > left[end]:
                left[end], back[end] = value, start
        for start, end, score in reversed(arcs):
            value = right[end] + score
            if value > right[start]:
                right[start] = value
        places = [size]
        while places[-1]:
            places.append(back[places[-1]])
        places.reverse()
        taken = set(zip(places, places[1:]))
        others = [left[start] + score + right[end] for start, end, score in arcs if (start, end) not in taken]
        ids = tuple(i for start, end in zip(places, places[1:]) for i in self.arc_ids(word[start:end]))
        return left[size], ids, left[size] - max(others, default=worst)

    def best_of(self, words: list[str]) -> list[tuple[float, tuple[int, ...], float]]:
        """`best` of many words."""
        total, ids, counts, loss = self.best_arrays(words)
        ends = np.cumsum(counts)
        return [(t, tuple(ids[end - n : end].tolist()), lost) for t, n, end, lost in zip(total.tolist(), counts.tolist(), ends.tolist(), loss.tolist())]

    def best_arrays(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """`best` of many words at once: scores, the ids of all words, how many each has, and losses.

        Works on arrays of (word, end, length of the last piece), so words should be of similar length.
        """
        sizes = np.array([len(word) for word in words])
        n, width, longest = len(words), int(sizes.max()), min(self.longest, int(sizes.max()))
        characters = np.zeros((n, width), np.uint64)
        inside = np.arange(width) < sizes[:, None]
        characters[inside] = np.frombuffer("".join(words).encode("utf-32-le"), "<u4") + np.uint64(1)
        worst = float("-inf")
        scores, ids = np.full((n, width + 1, longest), worst), np.full((n, width + 1, longest), -1)
        row, start = np.nonzero(inside)
        key = np.zeros(len(row), np.uint64)
        for length in range(1, longest + 1):
            key = key * np.uint64(_FACTOR) + characters[row, start + length - 1]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            scores[row[hit], start[hit] + length, length - 1] = self.key_scores[at[hit]]
            ids[row[hit], start[hit] + length, length - 1] = self.key_ids[at[hit]]
            if length == 1:
                for r, s in zip(row[~hit].tolist(), start[~hit].tolist()):
                    scores[r, s + 1, 0] = self.byte_score * len(words[r][s].encode())
            at = np.minimum(np.searchsorted(self.begins, key), len(self.begins) - 1)
            on = (self.begins[at] == key) & (start + length < sizes[row])
            row, start, key = row[on], start[on], key[on]
        left, right, back = np.full((n, width + 1), worst), np.full((n, width + 1), worst), np.zeros((n, width + 1), np.int64)
        left[:, 0] = 0
        every = np.arange(n)
        right[every, sizes] = 0
        for end in range(1, width + 1):
            own = min(end, longest)
            value = left[:, end - own : end][:, ::-1] + scores[:, end, :own]
            back[:, end] = own - 1 - value[:, ::-1].argmax(axis=1)  # the longest of equal ones
            left[:, end] = value[every, back[:, end]]
        through = np.full((n, width + 1, longest), worst)
        for end in range(width, 0, -1):
            own = min(end, longest)
            value = right[:, end, None] + scores[:, end, :own]
            through[:, end, :own] = value + left[:, end - own : end][:, ::-1]
            part = right[:, end - own : end]
            np.maximum(part, value[:, ::-1], out=part)
        # The pieces of each word from its end on, taken off all words at the same time.
        rows, owns, ends = [], [], []
        place, live = sizes.copy(), every
        while len(live):
            last = back[live, place[live]]
            rows.append(live)
            owns.append(ids[live, place[live], last])
            ends.append(place[live])
            through[live, place[live], last] = worst
            place[live] -= last + 1
            live = live[place[live] > 0]
        total = left[every, sizes]
        loss = total - through.reshape(n, -1).max(axis=1)
        row, own, end = (np.concatenate(parts) for parts in (rows, owns, ends))
        order = np.lexsort((end, row))
        row, own, end = row[order], own[order], end[order]
        lacking = np.flatnonzero(own < 0)  # characters without a piece become several bytes
        spelled = [self.arc_ids(words[row[k]][end[k] - 1]) for k in lacking.tolist()]
        width_of = np.ones(len(own), np.int64)
        width_of[lacking] = [len(own_bytes) for own_bytes in spelled]
        flat, begin = np.repeat(own, width_of), np.cumsum(width_of) - width_of
        for k, own_bytes in zip(lacking.tolist(), spelled):
            flat[begin[k] : begin[k] + len(own_bytes)] = own_bytes
        return total, flat, np.bincount(row, weights=width_of, minlength=n).astype(np.int64), loss

    def n_best(self, word: str, n: int) -> list[Path]:
        """The `n` best paths of a word, best first; of equal scores the path with the longer last pieces comes first."""
        best, ends = [0.0] + [float("-inf")] * len(word), [[] for _ in range(len(word) + 1)]
        for start, end, score in self.arcs(word):
            best[end] = max(best[end], best[start] + score)
            ends[end].append((start, score))
        # Entries: minus the score of the whole path, place, order of arrival, score so far, ids to the right as a chain.
        queue, order, found = [(-best[-1], len(word), 0, 0.0, None)], 1, []
        while queue and len(found) < n:
            _, place, _, done, chain = heapq.heappop(queue)
            if not place:
                ids = []
                while chain:
                    ids.extend(chain[0])
                    chain = chain[1]
                found.append((done, tuple(ids)))
                continue
            for start, score in ends[place]:
                own = self.arc_ids(word[start:place])
                heapq.heappush(queue, (-(best[start] + score + done), start, order, done + score, (own, chain)))
                order += 1
        return found

    def decode_word(self, ids: Iterable[int]) -> str:
        """The text of ids with its marks; bytes are joined."""
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: marks become spaces, bytes are joined, the mark in front goes."""
        text = self.decode_word(ids).replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=4)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


class _Grown:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.values, self.size = np.empty(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self.values):
            grown = np.empty(2 * end, self.values.dtype)
            grown[: self.size] = self.values[: self.size]
            self.values = grown
        self.values[self.size : end] = values
        self.size = end


class _Known:
    """Best paths of words as arrays: a word is a number in `index`; its ids lie from `starts` on."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        self.scores, self.losses, self.starts, self.counts = _Grown(np.float64), _Grown(np.float64), _Grown(np.int64), _Grown(np.int64)
        self.ids, self.whole = _Grown(np.uint32), _Grown(np.bool_)

    def add(self, words: list[str], total: np.ndarray, ids: np.ndarray, counts: np.ndarray, loss: np.ndarray, whole: list[bool]) -> None:
        first = len(self.index)
        self.index.update(zip(words, range(first, first + len(words))))
        self.chars += sum(map(len, words))
        self.starts.add(self.ids.size + np.cumsum(counts) - counts)
        for own, values in ((self.ids, ids), (self.counts, counts), (self.scores, total), (self.losses, loss), (self.whole, whole)):
            own.add(values)

    def ids_of(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of words one after the other."""
        counts = self.counts.values[numbers]
        ends = np.cumsum(counts)
        shift = self.starts.values[numbers] - (ends - counts)
        return self.ids.values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(shift, counts)]


#: The words of a text, and their numbers.
Prepared = tuple[list[str], np.ndarray]


class Segmenter:
    """N-best segmentations of whole texts; best paths of words are kept in a bounded table."""

    def __init__(self, path: str, n: int):
        self.model, self.n, self.known, self.searched = piece_model(path), n, _Known(), {}

    def prepare(self, texts: list[str]) -> list[Prepared]:
        """The words of texts. Best paths of new words are found together, those of long words one by one."""
        if len(self.known.index) > MEMO_WORDS or self.known.chars > MEMO_WORDS * SHORT:
            self.known, self.searched = _Known(), {}
        known, model = self.known, self.model
        words = [_WORDS.findall(model.normalized(text)) for text in texts]
        new = sorted({word for own in words for word in own if word not in known.index}, key=len)
        n_short = next((i for i, word in enumerate(new) if len(word) > SHORT), len(new))
        start = 0
        while start < n_short:  # words that are searched together are of similar length
            most = max(6, len(new[start]) * 4 // 3)
            end = bisect_right(new, most, start, min(start + BLOCK, n_short), key=len)
            self._add(new[start:end], model.best_arrays(new[start:end]))
            start = end
        for word in new[n_short:]:
            total, ids, loss = model.best(word)
            self._add([word], (np.array([total]), np.array(ids), np.array([len(ids)]), np.array([loss])))
        index = known.index
        return [(own, np.fromiter(map(index.__getitem__, own), np.int64, len(own))) for own in words]

    def _add(self, words: list[str], found: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]) -> None:
        ids, ends = found[1].tolist(), np.cumsum(found[2]).tolist()
        decoded = [self.model.decode_word(ids[start:end]) for start, end in zip([0, *ends], ends)]
        self.known.add(words, *found, [word == text for word, text in zip(words, decoded)])

    def _paths(self, word: str) -> list[Path]:
        paths = self.searched.get(word)
        if paths is None:
            paths = self.model.n_best(word, self.n)
            if len(word) <= SHORT:
                self.searched[word] = paths
        return paths

    def ranked(self, prepared: Prepared) -> list[tuple[float, dict[int, tuple[int, ...]]]]:
        """The best `n` paths of the text: what each loses against the best one, and the words where it differs.

        They leave the best path only in the n - 1 words whose second path loses least; only these are searched further.
        """
        words, numbers = prepared
        known = self.known
        mixes: list[tuple[float, dict[int, tuple[int, ...]]]] = [(0.0, {})]
        losses = known.losses.values[numbers]
        for i in np.argsort(losses, kind="stable")[: self.n - 1].tolist():
            if losses[i] == float("inf"):
                break
            number = int(numbers[i])
            score, own = float(known.scores.values[number]), tuple(known.ids_of(numbers[i : i + 1]).tolist())
            choices = [(0.0, own), *((max(0.0, score - other), ids) for other, ids in self._paths(words[i]) if ids != own)]
            longer = [(cost + more, {**mix, i: ids} if ids != own else mix) for cost, mix in mixes for more, ids in choices]
            mixes = sorted(longer, key=lambda mix: mix[0])[: self.n]
        return mixes

    def score(self, prepared: Prepared) -> float:
        """The score of the best path of a text."""
        return float(self.known.scores.values[prepared[1]].sum())

    def segmentations(self, prepared: Prepared) -> list[Path]:
        """The best `n` paths of a prepared text (fewer if there are no more), best first. No words have one empty path."""
        total = self.score(prepared)
        ids = [self.known.ids_of(prepared[1][i : i + 1]).tolist() for i in range(len(prepared[0]))]
        return [(total - cost, tuple(k for i, own in enumerate(ids) for k in mix.get(i, own))) for cost, mix in self.ranked(prepared)]


@lru_cache(maxsize=4)
def segmenter_of(path: str, n: int) -> Segmenter:
    """One for each Python worker, so that tasks that follow find its words."""
    return Segmenter(path, n)


def encode(docs: DataFrame, model: str, n: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and `paths` (score, ids) of every row, best first. A null text counts as empty: one path without ids.

    Nothing is shuffled; whole texts are segmented, however long.
    """
    common.ship_package(docs.sparkSession)
    source = common.texts(docs, id_col, text_col)
    kind = pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = segmenter_of(model, n)
        for batch in common.blocks(batches):
            prepared = segmenter.prepare(batch.column("text").to_pylist())
            paths = [[{"score": score, "ids": ids} for score, ids in segmenter.segmentations(words)] for words in prepared]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(paths, kind)], ["doc_id", "paths"])

    doc_id = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {doc_id}, paths array<struct<score:double,ids:array<int>>>")


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of rows of ids; null ids give the empty text."""
    common.ship_package(encoded.sparkSession)
    source = encoded.select(encoded[id_col].alias("doc_id"), encoded[ids_col].alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = piece_model(model)
        for batch in common.blocks(batches):
            texts = [own.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, text string")


def encoding_report(docs: DataFrame, model: str, n: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pieces, score, ids_crc32, n_found, last_score and round_trip of every row.

    ids_crc32 is that of the best path's ids as little-endian unsigned 32-bit numbers; last_score that of the last path
    found; round_trip says that every path found decodes to the text.
    """
    common.ship_package(docs.sparkSession)
    source = common.texts(docs, id_col, text_col)
    names = ["n_pieces", "score", "ids_crc32", "n_found", "last_score", "round_trip"]
    types = [pa.int64(), pa.float64(), pa.int64(), pa.int32(), pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = segmenter_of(model, n)
        for batch in common.blocks(batches):
            rows = []
            texts = batch.column("text").to_pylist()
            for text, prepared in zip(texts, segmenter.prepare(texts)):
                words, numbers = prepared
                mixes, score, ids = segmenter.ranked(prepared), segmenter.score(prepared), segmenter.known.ids_of(numbers)
                # Best paths of words are decoded once; a mark in the text itself comes back as a space.
                same = MARK not in text and bool(segmenter.known.whole.values[numbers].all()) and all(
                    segmenter.model.decode_word(own) == words[i] for _, mix in mixes for i, own in mix.items()
                )
                rows.append((len(ids), score, zlib.crc32(ids.astype("<u4").tobytes()), len(mixes), score - mixes[-1][0], same))
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    fields = "n_pieces long, score double, ids_crc32 long, n_found int, last_score double, round_trip boolean"
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {fields}")
