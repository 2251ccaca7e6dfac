"""Toxicity scores of whole texts: dense features, boosted trees, isotonic calibration.

The lexicons are learned from a bounded sample of labelled rows: whole words and beginnings of words that are common in
toxic documents and rare in others, as insults come with many endings. Their densities join second-person proximity,
capitals, punctuation and signs of obfuscation.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from math import log

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from docweave.llm import boosting, common
from docweave.llm.labelled import training_rows

#: Labelled rows to learn from and units of a lexicon, at most.
SAMPLE_ROWS = 12_000
LEXICON_UNITS = 3_000
HELD_OUT, FOLDS = 1, 3
THRESHOLD = 0.7
STEMS = range(4, 9)
#: Characters that the table of a worker's known words holds, and what an entry counts besides its word.
KNOWN_CHARS, ENTRY_CHARS = 12_000_000, 120
#: Words to the left and right that count as near.
NEAR = 6
#: Words of second-person address in the languages of the tables.
YOU = frozenset(
    "you your yours yourself yourselves ya u tu te toi ton ta tes vous votre vos du dich dir dein deine deinen deinem deiner "
    "ihr euch euer eure tú ti tuyo tuya usted ustedes vos vosotros os vuestro vuestra".split()
)
_WORD = re.compile(r"[\w@$*]+")
_LEET = str.maketrans("013457@$", "oieastas")
_ODD = regex.compile(r"\p{L}[0-9@$*]+\p{L}")
_LONG = regex.compile(r"(\p{L})\1{2,}")
#: Cheap tests that texts and words pass before the patterns above and below are tried on them.
_MAYBE_LONG = re.compile(r"(\w)\1\1")
_MAYBE_SPACED = re.compile(r"[^\W_][ .*-][^\W_][ .*-][^\W_][ .*-][^\W_]")
_SPACED = regex.compile(r"(?<!\p{L})(?:\p{L}[ .*-]){3,}\p{L}(?!\p{L})")
FEATURES = (
    "words", "word_hits", "stem_hits", "word_weight", "stem_weight", "word_density", "stem_density", "distinct_hits",
    "strongest", "strongest_stem", "hits_near_you", "you", "capital_words", "capital_hits", "exclamations", "questions",
    "punctuation", "odd_words", "plain_hits", "stretched", "spaced",
)


def units(word: str) -> list[str]:
    """What a lower-case word may be found by: itself (marked by =) and its beginnings."""
    return ["=" + word, *(word[:size] for size in STEMS if len(word) >= size)]


@dataclass(frozen=True)
class Lexicon:
    """Weights (smoothed log odds) of units."""

    weights: dict[str, float]

    @cached_property
    def heads(self) -> frozenset[str]:
        """The first characters that every beginning in the lexicon has."""
        return frozenset(unit[: STEMS[0]] for unit in self.weights if not unit.startswith("="))

    def find(self, word: str) -> tuple[float, float]:
        """Weight of the word itself and the largest weight of its beginnings."""
        if word[: STEMS[0]] not in self.heads:
            return self.weights.get("=" + word, 0.0), 0.0
        own = self.weights.get("=" + word, 0.0)
        return own, max((self.weights.get(word[:size], 0.0) for size in STEMS if len(word) >= size), default=0.0)


def lexicon(counts: list[tuple[str, int, int]], n_toxic: int, n_clean: int, most: int = LEXICON_UNITS) -> Lexicon:
    """Units of at least three toxic documents whose odds are at least five times even, the most telling `most` of them."""
    scored = []
    for unit, toxic, clean in counts:
        odds = log((toxic + 0.5) / (n_toxic + 1)) - log((clean + 0.5) / (n_clean + 1))
        if toxic >= 3 and odds >= log(5):
            scored.append((toxic * odds, unit, odds))
    scored.sort(key=lambda x: (-x[0], x[1]))
    return Lexicon({unit: odds for _, unit, odds in scored[:most]})


def words_of(text: str) -> list[str]:
    """Runs of letters, digits and the signs that stand in for letters."""
    return _WORD.findall(text.replace("_", " ") if "_" in text else text)


class _Facts(dict):
    """What is known of words: None for most, else weight of the word, of its beginnings, and the marks that it has.

    A word is looked at once; the table is emptied when it holds `KNOWN_CHARS` characters.
    """

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.chars = lexicon, 0

    def __missing__(self, word: str) -> tuple | None:
        self.chars += len(word) + ENTRY_CHARS
        if self.chars > KNOWN_CHARS:
            self.clear()
            self.chars = 0
        low = word.lower()
        own, stem = self.lexicon.find(low)
        plain, letters = False, low.isalpha()
        if not own and not letters:
            read = low.translate(_LEET)
            if read != low and (found := self.lexicon.find(read)) > (own, stem):
                (own, stem), plain = found, True
        odd = 0 if letters else len(_ODD.findall(word))
        stretched = len(_LONG.findall(word)) if _MAYBE_LONG.search(word) else 0
        facts = (own, stem, plain, low in YOU, word.isupper(), len(word) > 2, odd, stretched)
        self[word] = found = facts if own or stem or facts[3] or facts[4] or odd or stretched else None
        return found


class Measurer:
    """FEATURES of texts."""

    def __init__(self, lexicon: Lexicon):
        self.known = _Facts(lexicon)

    def features(self, text: str) -> list[float]:
        """FEATURES of a whole text; zeros for a text without words."""
        words = words_of(text)
        n, size, known = len(words), max(1, len(text)), self.known
        if not n:
            return [0.0] * len(FEATURES)
        marked = [(i, facts) for i, word in enumerate(words) if (facts := known[word])]
        hits = [(i, facts) for i, facts in marked if facts[0] or facts[1]]
        you = {i for i, facts in marked if facts[3]} if hits else ()
        own, stem = [f[0] for _, f in hits if f[0]], [f[1] for _, f in hits if f[1]]
        spaced = len(_SPACED.findall(text)) if _MAYBE_SPACED.search(text) else 0
        share = lambda count, of=n: count / max(1, of)
        return [
            log(1 + n), float(len(own)), float(len(stem)), sum(own), sum(stem), share(sum(own)), share(sum(stem)),
            float(len({words[i] for i, _ in hits})), max(own, default=0.0), max(stem, default=0.0),
            share(sum(any(j in you for j in range(i - NEAR, i + NEAR + 1)) for i, _ in hits)), share(len(you)),
            share(sum(f[4] and f[5] for _, f in marked)), share(sum(f[4] for _, f in hits), len(hits)),
            text.count("!") / size, text.count("?") / size, sum(map(text.count, ".,;:")) / size,
            share(sum(f[6] for _, f in marked)), float(sum(f[2] for _, f in hits)), share(sum(f[7] for _, f in marked)), share(spaced),
        ]

    def matrix(self, texts: list[str]) -> np.ndarray:
        return np.array([self.features(text) for text in texts], np.float64).reshape(len(texts), len(FEATURES))


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    trees: boosting.Trees
    calibration: boosting.Isotonic

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.calibration(self.trees.score(x))


def fold(column: str = "doc_id") -> Column:
    return common.id_crc32(column) % FOLDS


def _count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each half and label that hold a unit; sums are handed on when the table has grown."""

    def flush(counts: Counter) -> pa.RecordBatch:
        keys = list(counts)
        columns = [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.int32())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(counts.values(), pa.int64())], ["unit", "half", "label", "n"])

    counts: Counter = Counter()
    for batch in common.blocks(batches):
        for half, label, text in zip(*(batch.column(c).to_pylist() for c in ("half", "label", "text"))):
            words = {word.lower() for word in words_of(text)}
            counts.update((unit, half, label) for unit in {unit for word in words for unit in units(word)})
        if len(counts) > 400_000:
            yield flush(counts)
            counts.clear()
    yield flush(counts)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, label: str = "toxic") -> Model:
    """Lexicon, trees and calibration from a bounded sample of labels outside the held-out fold.

    The rows are halved: the features of one half are measured with the lexicon of the other, so that the trees do not
    learn from words that were chosen by the same row; the calibration sees scores of trees of the other half only.
    """
    spark = docs.sparkSession
    common.ship_package(spark)
    rows = common.written(
        training_rows(docs, labels, label, fold() != HELD_OUT, sample_rows)
        .select("doc_id", "label", (common.id_crc32() % 2 ** 20 >= 2 ** 19).cast("int").alias("half"), "text"),
        "toxicity-sample",
    )
    sizes = {(r.half, r.label): r["count"] for r in rows.groupBy("half", "label").count().collect()}
    of = lambda label, halves: sum(sizes.get((half, label), 0) for half in halves)
    counted = rows.select("half", "label", "text").mapInArrow(_count_units, "unit string, half int, label int, n long")
    when = lambda half, label: F.sum(F.when((F.col("half") == half) & (F.col("label") == label), F.col("n")).otherwise(0))
    by_unit = counted.groupBy("unit").agg(*[when(half, label).alias(f"n{half}{label}") for half in (0, 1) for label in (0, 1)])
    by_unit = common.written(by_unit.where("n01 + n11 >= 3"), "toxicity-units")

    def learned(halves: tuple[int, ...]) -> Lexicon:
        toxic, clean = (sum(F.col(f"n{half}{label}") for half in halves) for label in (1, 0))
        telling = (F.log((toxic + 0.5) / (of(1, halves) + 1)) - F.log((clean + 0.5) / (of(0, halves) + 1))) * toxic
        found = by_unit.select("unit", toxic.alias("toxic"), clean.alias("clean"), telling.alias("telling")).where("toxic >= 3")
        best = found.orderBy(F.desc("telling"), "unit").limit(2 * LEXICON_UNITS).collect()
        return lexicon([(r.unit, r.toxic, r.clean) for r in best], of(1, halves), of(0, halves))

    whole, others = learned((0, 1)), {0: learned((1,)), 1: learned((0,))}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measurers = {half: Measurer(own) for half, own in others.items()}
        for batch in common.blocks(batches):
            halves = batch.column("half").to_pylist()
            x = [measurers[half].features(text) for half, text in zip(halves, batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("half"), batch.column("label"), pa.array(x, pa.list_(pa.float64()))], ["half", "label", "x"])

    found = rows.select("half", "label", "text").mapInArrow(measure, "half int, label int, x array<double>").toPandas()
    if not len(found):
        return Model(whole, boosting.constant(0.1, len(FEATURES)), boosting.isotonic(np.zeros(0), np.zeros(0)))
    x = np.array(found["x"].tolist())
    order = np.lexsort(x.T)
    x, y, half = x[order], found["label"].to_numpy()[order], found["half"].to_numpy()[order]
    trees, scores = boosting.fit(x, y), np.zeros(len(y))
    for own in (0, 1):
        scores[half == own] = boosting.fit(x[half != own], y[half != own]).score(x[half == own])
    return Model(whole, trees, boosting.isotonic(scores, y))


def toxicity_scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted of every row; null and empty texts are scored by zeros.

    A long text is read whole. Equal texts have equal scores; repeated rows and null ids give a row each, an empty table
    none. A score equal to the threshold is predicted 1.
    """
    common.ship_package(docs.sparkSession)
    source = common.texts(docs, id_col, text_col).select("doc_id", (fold() == HELD_OUT).alias("held_out"), "text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measurer = Measurer(model.lexicon)
        for batch in common.blocks(batches):
            scores = model.scores(measurer.matrix(batch.column("text").to_pylist()))
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    doc_id = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(score, f"doc_id {doc_id}, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that are not rejected, with all columns; nothing is shuffled."""
    common.ship_package(docs.sparkSession)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measurer = Measurer(model.lexicon)
        for batch in common.blocks(batches):
            texts = [text or "" for text in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(model.scores(measurer.matrix(texts)) < threshold))

    return docs.mapInArrow(keep, docs.schema)
