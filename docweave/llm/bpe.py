"""Byte-level BPE: chunks of text, ids of chunks, and token counts by merging arrays.

A text is cut at single spaces, which the pre-tokenizer never joins with what stands before them. A chunk's ids or
count are kept in a bounded table, as most chunks come again.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import regex

#: Fixed values of the public tokenizer: the pre-tokenizer's pattern with Unicode's white space, and its special string.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
SPECIAL = "<|endoftext|>"

#: Chunks kept by one Python worker, and the longest chunk that is kept.
MEMO_CHUNKS = 300_000
MEMO_CHARS = 64
#: A space before white space or the end: such texts are cut by the pattern.
_ODD_SPACE = re.compile(r" (?=\s|\Z)")
_PRE_TOKENS = regex.compile(PATTERN)


def _bytes_of_characters() -> dict[str, int]:
    """Printable Latin-1 characters stand for their own byte, those from 256 on for the other bytes in order."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Ids of byte strings, and the merges as sorted arrays: pair (a * size + b), rank, merged id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        self.special = {token["content"]: token["id"] for token in data["added_tokens"]}
        to_byte = _bytes_of_characters()
        ids, special = model["vocab"], set(self.special)
        self.ranks = {bytes(to_byte[c] for c in token): i for token, i in ids.items() if token not in special}
        self.size = max(ids.values()) + 1
        byte_ids = [self.ranks[bytes([b])] for b in range(256)]
        self.byte_ids = np.array(byte_ids, np.int64)
        pairs, merged = [], []
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pairs.append(ids[a] * self.size + ids[b])
            merged.append(ids[a + b])
        order = np.argsort(pairs)
        self.pairs = np.array(pairs, np.int64)[order]
        self.pair_ranks, self.merged = order.astype(np.int64), np.array(merged, np.int64)[order]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def chunks(text: str) -> tuple[str, list[str]]:
    """First chunk, and the chunks that follow a space each; empty if the text has to be cut by the pattern."""
    first, *rest = text.split(" ")
    return first, rest


def count_symbols(words: list[bytes], vocab: Vocabulary) -> np.ndarray:
    """Symbols left of each word when no pair can be merged any more.

    All words lie in one array. In each step every word that still has a mergeable pair merges its pair of lowest rank,
    at all places from left to right; words without one leave the array.
    """
    lengths = np.array([len(word) for word in words], np.int64)
    left = lengths.copy()
    symbols = vocab.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), lengths)
    last, none = len(vocab.pairs) - 1, len(vocab.pairs)
    while len(symbols) > 1:
        pair = symbols[:-1] * vocab.size + symbols[1:]
        at = np.minimum(np.searchsorted(vocab.pairs, pair), last)
        found = (vocab.pairs[at] == pair) & (word[:-1] == word[1:])
        rank = np.where(found, vocab.pair_ranks[at], none)
        rank = np.append(rank, none)
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        sizes = np.diff(np.append(starts, len(word)))
        lowest = np.repeat(np.minimum.reduceat(rank, starts), sizes)
        left[word[starts]] = sizes
        hit = np.flatnonzero((rank == lowest) & (rank < none))
        if not len(hit):
            break
        # Of adjoining places (a run of one symbol) every second is merged.
        run = np.append(True, np.diff(hit) > 1)
        run_start = np.maximum.accumulate(np.where(run, hit, 0))
        hit = hit[(hit - run_start) % 2 == 0]
        symbols[hit] = vocab.merged[at[hit]]
        stay = lowest < none
        stay[hit + 1] = False
        symbols, word = symbols[stay], word[stay]
    if len(symbols) == 1:
        left[word[0]] = 1
    return left


class _Chunked:
    """Walks over texts and asks `_fill` for chunks that are not in its table."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.plain: dict = {}
        self.spaced: dict = {}
        self.cut = re.compile("|".join(map(re.escape, self.vocab.special))) if self.vocab.special else None

    def _parts(self, text: str) -> tuple[list[str], list[str], list[str]]:
        """Special strings, and chunks without and with a space before them, in order when a part has no special string."""
        specials = self.cut.findall(text) if self.cut and "<|" in text else []
        plain, spaced = [], []
        for part in self.cut.split(text) if specials else (text,):
            if _ODD_SPACE.search(part):
                plain.extend(_PRE_TOKENS.findall(part))
            else:
                first, rest = chunks(part)
                plain.append(first)
                spaced.extend(rest)
        return specials, plain, spaced

    def _room(self) -> None:
        if len(self.plain) + len(self.spaced) > MEMO_CHUNKS:
            self.plain.clear()
            self.spaced.clear()


class TokenCounter(_Chunked):
    """Token counts of texts; chunks that are new in a block of texts are merged together."""

    def _fill(self, plain: set[str], spaced: set[str]) -> None:
        words, owners = [], []
        keys = [(self.plain, chunk, chunk) for chunk in plain] + [(self.spaced, chunk, " " + chunk) for chunk in spaced]
        for owner, (_, _, text) in enumerate(keys):
            own = _PRE_TOKENS.findall(text)
            words.extend(word.encode() for word in own)
            owners.extend([owner] * len(own))
        if not keys:
            return
        counts = count_symbols(words, self.vocab) if words else np.zeros(0)
        totals = np.bincount(np.array(owners, np.int64), counts, minlength=len(keys)).astype(np.int64).tolist()
        for (memo, chunk, _), total in zip(keys, totals):
            memo[chunk] = total

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text. Chunks of this block are looked up after all new ones were merged."""
        self._room()
        parts = [self._parts(text) for text in texts]
        plain, spaced = set(), set()
        for _, own_plain, own_spaced in parts:
            plain.update(own_plain)
            spaced.update(own_spaced)
        self._fill(plain - self.plain.keys(), spaced - self.spaced.keys())
        return [
            len(specials) + sum(map(self.plain.__getitem__, own_plain)) + sum(map(self.spaced.__getitem__, own_spaced))
            for specials, own_plain, own_spaced in parts
        ]


class IdEncoder(_Chunked):
    """Ids of texts as little-endian unsigned 32-bit numbers; new chunks go to the library."""

    def __init__(self, path: str):
        super().__init__(path)
        import tiktoken

        self.library = tiktoken.Encoding("chunks", pat_str=PATTERN.replace("\\p{White_Space}", "\\s").replace("\\P{White_Space}", "\\S"), mergeable_ranks=self.vocab.ranks, special_tokens={})

    def _get(self, memo: dict, chunk: str, text: str) -> bytes:
        ids = memo.get(chunk)
        if ids is None:
            ids = np.array(self.library.encode_ordinary(text), "<u4").tobytes()
            if len(chunk) <= MEMO_CHARS:
                memo[chunk] = ids
        return ids

    def ids(self, text: str) -> bytes:
        self._room()
        out = []
        specials = self.cut.findall(text) if self.cut and "<|" in text else []
        for i, part in enumerate(self.cut.split(text) if specials else (text,)):
            if i:
                out.append(np.array([self.vocab.special[specials[i - 1]]], "<u4").tobytes())
            if _ODD_SPACE.search(part):
                out.extend(self._get(self.plain, word, word) for word in _PRE_TOKENS.findall(part))
                continue
            first, rest = chunks(part)
            out.append(self._get(self.plain, first, first))
            spaced = self.spaced
            for chunk in rest:
                ids = spaced.get(chunk)
                out.append(self._get(spaced, chunk, " " + chunk) if ids is None else ids)
        return b"".join(out)
