"""Secrets in whole texts: fixed patterns, and tokens that pass for random.

A long token with letters and digits is taken for a number written in some encoding, the narrowest that has its
characters. A run of token characters is judged whole, and so is each part between its slashes, as paths join tokens to
names; '=' ends a run, and belongs to it only as padding. Three tests ask whether a token could be uniform in its
alphabet: chi-squared (single characters and classes), runs about the middle, serial correlation. Across all tokens of one encoding and length class, the Benjamini-Hochberg
procedure rejects randomness; tokens that are not rejected, and are long enough for the tests to tell, are secrets.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from math import erfc, log2, log10, sqrt

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docweave.llm import common

#: The kinds of spans in their order, and their patterns.
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

_RUN = re.compile(r"([A-Za-z0-9+/_-]+)(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
LEAST_RUN = 20
#: A token must be worth so many bits if it is random.
LEAST_BITS = 80
#: Share of the rejections of randomness that may be wrong.
FALSE_SHARE = 0.05
#: p-values are counted in steps of a tenth of a power of ten, down to 1e-30.
STEPS = 300

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from the narrowest, in the order of their digits.
ENCODINGS = {
    "hex": _DIGITS + "abcdef", "upper_hex": _DIGITS + "ABCDEF", "base32": _UPPER + "234567", "lower36": _DIGITS + _LOWER,
    "upper36": _DIGITS + _UPPER, "base62": _DIGITS + _UPPER + _LOWER, "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
_PLACES = {name: {c: i for i, c in enumerate(alphabet)} for name, alphabet in ENCODINGS.items()}

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and without overlap in each kind; by start, then kind."""
    found: list[Span] = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    if any(len(word) >= LEAST_HEX for word in text.split()):
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text) if len(m[0]) >= LEAST_HEX]
    return sorted(found)


def encoding(token: str) -> str | None:
    """The narrowest encoding of a token that has letters and digits."""
    used = set(token)
    if not used & set(_DIGITS) or not used & set(_LOWER + _UPPER):
        return None
    return next((name for name, alphabet in ENCODINGS.items() if used <= set(alphabet)), None)


def _upper_tail(chi2: float, degrees: float) -> float:
    """P(chi-squared >= chi2) by the cube-root approximation."""
    part = 2 / (9 * degrees)
    return erfc(((chi2 / degrees) ** (1 / 3) - 1 + part) / sqrt(2 * part)) / 2


def randomness(token: str, name: str) -> float:
    """p-value of uniformity over the encoding: the least of four tests, times four."""
    alphabet, places = ENCODINGS[name], [_PLACES[name][c] for c in token]
    n, m = len(places), len(alphabet)
    uniform = sum(c * c for c in Counter(places).values()) * m / n - n
    p_values = [_upper_tail(uniform, m - 1)]
    classes = [(set(chars) & set(alphabet)) for chars in (_DIGITS, _LOWER, _UPPER)]
    seen = [(sum(c in own for c in token), n * len(own) / m) for own in classes if own]
    if len(seen) > 1:
        p_values.append(_upper_tail(sum((count - mean) ** 2 / mean for count, mean in seen), len(seen) - 1))
    high = [2 * place >= m for place in places]
    ups = sum(high)
    downs = n - ups
    if ups and downs:
        mean = 2 * ups * downs / n + 1
        variance = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
        p_values.append(erfc(abs(runs - mean) / sqrt(2 * variance)))
    else:
        p_values.append(2.0 ** (1 - n))
    centre = sum(places) / n
    spread = sum((place - centre) ** 2 for place in places)
    serial = sum((a - centre) * (b - centre) for a, b in zip(places, places[1:])) / spread if spread else 1.0
    p_values.append(erfc(abs(serial + 1 / n) * sqrt(n / 2)))
    return min(1.0, 4 * min(p_values))


def _tokens(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end with padding, and token of each run, followed by those of its parts if it has slashes."""
    for m in _RUN.finditer(text):
        run, start = m[1], m.start()
        if len(run) < LEAST_RUN:
            continue
        yield start, m.end(), run
        if "/" in run:
            for part in run.split("/"):
                end = start + len(part)
                yield start, m.end() if end == m.end(1) else end, part
                start = end + 1


def candidates(text: str, taken: list[Span]) -> list[tuple[int, int, str, int]]:
    """Tokens to judge that touch no taken span: start, end, class (encoding and octave of length), step of the p-value.

    By start, a run before its parts.
    """
    if not any(len(word) >= LEAST_RUN and not word.isalpha() and any(c.isdigit() for c in word) for word in text.split()):
        return []
    found = []
    for start, end, token in _tokens(text):
        if len(token) < LEAST_RUN or (name := encoding(token)) is None or len(token) * log2(len(ENCODINGS[name])) < LEAST_BITS:
            continue
        if any(first < end and start < last for first, _, last in taken):
            continue
        p = randomness(token, name)
        step = min(STEPS, int(-10 * log10(max(p, 1e-31))))
        found.append((start, end, f"{name}:{len(token).bit_length()}", step))
    return found


def learn_limits(docs: DataFrame, text_col: str = "text", false_share: float = FALSE_SHARE) -> dict[str, int]:
    """For each class the least step at which randomness is rejected, from the tokens of all rows.

    p-values are counted by class and step before anything is shuffled: at most a few thousand rows. A class without
    rejections is left out.
    """
    common.ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in common.blocks(batches):
            for text in batch.column("text").to_pylist():
                counts.update((own, step) for _, _, own, step in candidates(text, base_spans(text)))
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array(counts.values(), pa.int64())],
            ["class", "step", "n"],
        )

    source = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = source.mapInArrow(count, "class string, step int, n long").groupBy("class", "step").agg(F.sum("n").alias("n"))
    by_class: dict[str, dict[int, int]] = {}
    for row in counts.collect():
        by_class.setdefault(row["class"], {})[row["step"]] = row["n"]
    limits = {}
    for own, steps in by_class.items():
        total, below = sum(steps.values()), 0
        for step in sorted(steps, reverse=True):
            below += steps[step]
            if 10 ** (-step / 10) <= false_share * below / total:
                limits[own] = step
    return limits


def spans(text: str, limits: dict[str, int]) -> tuple[list[Span], list[Span]]:
    """Spans of the fixed patterns, and all spans."""
    base, added, at = base_spans(text), [], 0
    for start, end, own, step in candidates(text, base):
        if start >= at and step < limits.get(own, STEPS + 1):  # parts of a run that is a secret are in it
            added.append((start, 3, end))
            at = end
    return base, sorted(base + added)


def written_spans(found: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def find_secrets(docs: DataFrame, limits: dict[str, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_random of every row.

    Spans are kind:start:end in code points, by start and kind. A null or empty text has none: the digest is that of the
    empty string. Overlapping spans of different kinds are all listed; a random token touches no other span. Whole texts
    are scanned, however long; repeated rows and null ids give a row each, an empty table none.
    """
    common.ship_package(docs.sparkSession)
    source = common.texts(docs, id_col, text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.blocks(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                base, every = spans(text, limits)
                kinds = Counter(kind for _, kind, _ in every)
                digest = hashlib.sha256(written_spans(base).encode()).hexdigest()
                rows.append((kinds[0], kinds[1], kinds[2], digest, written_spans(every), kinds[3]))
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    doc_id = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(scan, f"doc_id {doc_id}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")


def redacted(text: str, limits: dict[str, int], mark: str = "[SECRET]") -> str:
    """`text` with every stretch of spans replaced by one mark."""
    out, at = [], 0
    for start, _, end in spans(text, limits)[1]:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def redact(docs: DataFrame, limits: dict[str, int], text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """`docs` with secrets replaced in the text; `length_col`, if there is one, follows. Null texts stay null."""
    common.ship_package(docs.sparkSession)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.blocks(batches):
            texts = [None if text is None else redacted(text, limits) for text in batch.column(text_col).to_pylist()]
            new = {text_col: pa.array(texts, batch.column(text_col).type)}
            yield pa.RecordBatch.from_arrays([new.get(name, batch.column(name)) for name in batch.schema.names], batch.schema.names)

    clean = docs.mapInArrow(rewrite, docs.schema)
    if length_col in docs.columns:
        clean = clean.withColumn(length_col, F.char_length(text_col).cast(docs.schema[length_col].dataType))
    return clean
