"""Quality rules as a ledger of bits: rules are evaluated once, policies are masks over what was stored.

Bit b of `fail_bits` says that rule b failed. A policy is a mask with a version; changing it needs no second look at
the texts. Everything is a column expression over one row, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from docweave.llm import common

REPEAT_WORDS = 8
SYMBOLS = "#*$%&|<>"
_GAPS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[], Column]


def _over(column: str, percent: int, of: str) -> Callable[[], Column]:
    """`column` is more than `percent` per cent of `of`; whole numbers, so engines agree."""
    return lambda: 100 * F.col(column) > percent * F.col(of)


#: The place of a rule is its bit; new rules go to the end.
RULES = (
    Rule("few_words", lambda: F.col("n_words") < 20),
    Rule("repeated_words", _over("n_repeat_words", 30, "n_words")),
    Rule("symbols", _over("n_symbols", 10, "n_words")),
    Rule("capitals", _over("n_capitals", 40, "word_chars")),
    Rule("exclamations", _over("n_exclamations", 20, "n_words")),
    Rule("duplicate_lines", _over("n_dup_lines", 30, "n_lines")),
    Rule("long_words", lambda: F.col("word_chars") > 12 * F.col("n_words")),
    Rule("short_words", lambda: F.col("word_chars") < 2 * F.col("n_words")),
)
BASE = ("few_words", "repeated_words")
#: Versioned policies: the rules that reject.
POLICIES = {1: BASE, 2: tuple(rule.name for rule in RULES)}


def mask(names: tuple[str, ...]) -> int:
    places = {rule.name: bit for bit, rule in enumerate(RULES)}
    return sum(1 << places[name] for name in names)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with `value` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _count(characters: str) -> Column:
    """How often ASCII `characters` occur in `text`, by lengths before and after removal."""
    rest = F.col("text")
    for character in characters:
        rest = F.replace(rest, F.lit(character), F.lit(""))
    return (F.octet_length("text") - F.octet_length(rest)).cast("long")


def _repeated(windows: Column) -> Column:
    """Words inside windows (given by their hashes, in order) that occur twice or more."""

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda s, i: F.least(F.coalesce(F.try_element_at(starts, i + 2) - s, F.lit(REPEAT_WORDS)), F.lit(REPEAT_WORDS)))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def starts(sorted_windows: Column) -> Column:
        same = lambda w, other: F.coalesce(other["h"] == w["h"], F.lit(False))
        twice = F.filter(
            sorted_windows,
            lambda w, i: same(w, F.get(sorted_windows, i - 1)) | same(w, F.get(sorted_windows, i + 1)),
        )
        return F.array_sort(F.transform(twice, lambda w: w["i"]))

    by_hash = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _let(_let(by_hash, starts), covered)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the measurements of each row. Null and empty texts measure 0 everywhere.

    Windows are compared by 64-bit hashes within one document. A long text is one row and is measured whole; repeated
    rows and null ids are measured each, and an empty table has no measurements. A value equal to a rule's limit passes.
    """
    words = F.array_remove(F.split("text", common.WORD_GAP), "")
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    split = common.texts(docs, id_col, text_col).select("doc_id", "text", words.alias("words"), lines.alias("lines"))
    n = F.size("words")
    hashes = F.transform(F.sequence(F.lit(1), n - (REPEAT_WORDS - 1)), lambda i: F.xxhash64(F.slice("words", i, REPEAT_WORDS)))
    hashed = split.select(
        "doc_id", "text", "lines", n.cast("long").alias("n_words"),
        F.when(n >= REPEAT_WORDS, hashes).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    capitals = F.octet_length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long")
    n_repeat = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), _repeated(F.col("windows"))).otherwise(0)
    return hashed.select(
        "doc_id", "n_words", (F.char_length("text") - _count("".join(_GAPS))).alias("word_chars"),
        _count(SYMBOLS).alias("n_symbols"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        n_repeat.cast("long").alias("n_repeat_words"), capitals.alias("n_capitals"), _count("!").alias("n_exclamations"),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements of each row and `fail_bits`."""
    measured = measure(docs, id_col, text_col)
    bits = F.lit(0)
    for bit, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(rule.fails(), 1 << bit).otherwise(0))
    return measured.select("*", bits.alias("fail_bits"))


def apply_policy(rows: DataFrame, version: int) -> DataFrame:
    """`rows` of a ledger with `kept` by a policy; `base_failed` holds for every policy."""
    failed = lambda names: F.col("fail_bits").bitwiseAND(F.lit(mask(names))) != 0
    return rows.select(
        "*", failed(BASE).alias("base_failed"), (~failed(BASE) & ~failed(POLICIES[version])).alias("kept"),
        F.lit(version).alias("policy"),
    )


def ablations(rows: DataFrame, version: int) -> DataFrame:
    """For each rule of a policy: rows that fail it, rows that only it rejects, rows kept with and without it.

    Rows are first counted for each value of the bits, of which there are at most 2 ** rules.
    """
    whole = mask(POLICIES[version])
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(whole)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(mask((name,))).alias("bit")) for name in POLICIES[version]]))
    each = patterns.select("bits", "n", rules.alias("r")).select("bits", "n", "r.*")
    hit, alone = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits") == F.col("bit")
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("n_kept"),
        F.sum(F.when((F.col("bits") == 0) | alone, F.col("n")).otherwise(0)).alias("n_kept_without"),
    )
