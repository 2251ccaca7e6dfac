"""Tagging of plain text with a word list.

The word list has the columns `word`, `piece` (one or more `surface/TAG`, joined by `+`) and `token_type`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docweave.bounds import PLAN_ROWS, broadcast_if_small, computed_once, rows_if_small
from docweave.functions import text as T
from docweave.functions.dictionary import let, lookup, sums_before
from docweave.functions.tags import KOREAN, STOP_TYPES, Letters
from docweave.scratch import written_table

UNKNOWN_TAG = "NNG"
TOKENS = "array<struct<token:string,type:string,start_offset:int,end_offset:int,position:int,particle:boolean>>"


def word_list(lexicon: DataFrame) -> DataFrame:
    """One entry per word: the first piece in alphabetical order where a word is listed twice."""
    return lexicon.groupBy("word").agg(F.min(F.struct("piece", "token_type")).alias("entry")).select("word", "entry.*")


# Blanks below 256, so that a plain text is told by a short class.
_LOW_BLANKS = "".join(blank for blank in T.BLANKS if blank < "\u0100")

# Blanks that are no line breaks; a word never holds one.
_SEPARATORS = "".join(blank for blank in T.BLANKS if blank not in "\r\n")


def _words(text: Column, letters: Letters) -> Column:
    """The lower-cased words of `T.tagger_input`. Every separator becomes a space, which is cheaper to split by.

    A text that has nothing to drop is told by one quick test.
    """

    def without_others(blanked: Column) -> Column:
        dropped = F.regexp_replace(blanked, T.outside(letters.kept + T.BLANKS), "")
        return F.when(F.rlike(blanked, F.lit(T.only(letters.kept + _LOW_BLANKS))), blanked).otherwise(dropped)

    kept = let(T.blank_punctuation(text), without_others)
    spaced = F.translate(kept, _SEPARATORS + "\r\n", " " * len(_SEPARATORS))
    return F.filter(F.split(F.lower(spaced), " ", -1), lambda word: word != "")


def _unknown(word: Column) -> Column:
    return F.concat(word, F.lit(f"/{UNKNOWN_TAG}"))


def tag_sentences(
    sentences: DataFrame,
    lexicon: DataFrame,
    keys: Sequence[str],
    text_col: str = "sentence",
    out_col: str = "sentence_kma",
    letters: Letters = KOREAN,
    max_in_plan: int = PLAN_ROWS,
) -> DataFrame:
    """Add the tagged form of `text_col`. `keys` identify a row.

    A word list of at most `max_in_plan` entries is looked up in the row itself. A larger one is joined word
    by word, and the words are put back in order by a number of the row. Both ways give the same rows, also for null
    or repeated keys; a null text stays untagged.
    """
    entries = word_list(computed_once(lexicon, "lexicon"))
    small = rows_if_small(entries, max_in_plan)
    words = _words(F.col(text_col), letters)
    if small is not None:
        pieces = {row.word: row.piece for row in small}
        tagged = F.transform(words, lambda word: lookup(word, pieces, "string", _unknown(word)))
        return sentences.withColumn(out_col, F.array_join(tagged, " "))

    joined = _looked_up(sentences, words, entries.select("word", "piece"), F.coalesce("piece", _unknown(F.col("word"))))
    tagged = F.when(F.col(text_col).isNotNull(), F.array_join("_found", " "))
    return joined.withColumn(out_col, tagged).drop("_found")


# Type and marks of a word that the word list does not have.
_UNLISTED = {"type": UNKNOWN_TAG, "particle": False}
_ENTRY = "struct<type:string,particle:boolean>"


def _entry(token_type: Column, piece: Column) -> Column:
    """What analyser tokens need of a word list entry; that of an unlisted word where there is none."""
    return F.struct(
        F.coalesce(token_type, F.lit(UNKNOWN_TAG)).alias("type"), F.coalesce(F.contains(piece, F.lit("/J_")), F.lit(False)).alias("particle")
    )


def _first_words(words: Column, length: Column) -> Column:
    """The words that end within the first `length` characters of the cleaned text, in which they are one space apart."""
    text = F.array_join(words, " ")
    # With one character more the last piece is a cut word or an empty one.
    pieces = lambda: F.split(F.substring(text, F.lit(1), length + 1), " ", -1)
    cut = let(pieces(), lambda pieces: F.slice(pieces, F.lit(1), F.size(pieces) - 1))
    return F.when(F.char_length(text) <= length, words).otherwise(cut)


def _placed_tokens(words: str, starts: str, entries: str, types: Sequence[str] | None = None) -> Column:
    """Two analyser tokens per word: the word form (EOJEOL) and its content token, from three columns of arrays.

    With `types`, content tokens of other types are left out, and word forms without a particle.
    """

    def pair(word: Column, position: Column) -> Column:
        start = F.get(starts, position)
        place = [start.alias("start_offset"), (start + F.char_length(word)).alias("end_offset"), position.alias("position")]
        entry = F.get(entries, position)
        kind = entry["type"]
        content = F.when(kind.isin("VV", "VA", "XR"), F.concat(word, F.lit("/"), kind)).otherwise(word)
        form = F.struct(word.alias("token"), F.lit("EOJEOL").alias("type"), *place, entry["particle"].alias("particle"))
        token = F.struct(content.alias("token"), kind.alias("type"), *place, F.lit(False).alias("particle"))
        if types is None:
            return F.array(form, token)
        wanted = kind.isin(*types)
        none = F.array().cast(TOKENS)
        return F.when(entry["particle"], F.when(wanted, F.array(form, token)).otherwise(F.array(form))).otherwise(F.when(wanted, F.array(token)).otherwise(none))

    return F.flatten(F.transform(words, pair))


def _with_placed_tokens(rows: DataFrame, out_col: str, entries: Column, types: Sequence[str] | None = None) -> DataFrame:
    """Add the tokens of `_words`, an array of words, and of their `entries`.

    Offsets count characters of the cleaned text, in which words are one space apart. What the tokens are made of are
    columns until the end: within one expression, every `let` would copy all tokens once more.
    """
    starts = sums_before(F.transform("_words", lambda word: F.char_length(word) + 1))
    placed = rows.withColumns({"_starts": starts, "_entries": entries})
    return placed.withColumn(out_col, F.coalesce(_placed_tokens("_words", "_starts", "_entries", types), F.array().cast(TOKENS))).drop("_words", "_starts", "_entries")


def _looked_up(rows: DataFrame, words: Column, entries: DataFrame, found: Column) -> DataFrame:
    """`rows` as a written table with `_found`: what the joined entry of each word gives, in the order of the words.

    Rows are told apart by a number that is written once; only it travels with the words. `found` may use `word` and the
    columns of `entries`, which are null for an unlisted word. A row without words has an empty array.
    """
    numbered = written_table(rows.withColumn("_number", F.monotonically_increasing_id()), "rows")
    listed = (
        numbered.select("_number", F.posexplode(words).alias("_i", "word"))
        .join(broadcast_if_small(entries), "word", "left")
        .groupBy("_number")
        .agg(F.array_sort(F.collect_list(F.struct("_i", found.alias("found"))))["found"].alias("_found"))
    )
    empty = F.array().cast(listed.schema["_found"].dataType)
    return numbered.join(listed, "_number", "left").withColumn("_found", F.coalesce("_found", empty)).drop("_number")


def with_word_tokens(
    rows: DataFrame,
    text_col: str,
    lexicon: DataFrame,
    out_col: str = "tokens",
    letters: Letters = KOREAN,
    max_in_plan: int = PLAN_ROWS,
    within: str | None = None,
    types: Sequence[str] | None = None,
) -> DataFrame:
    """Add the analyser tokens of `text_col`: two per word, with offsets in the cleaned text; none for a null text.

    A word list of at most `max_in_plan` entries is looked up in the row. The words of a larger one are joined, and the
    tokens are put back in order by a number of the row; both ways give the same rows, whatever keys they have.

    A caller that drops most tokens names what it needs, and no others are made: `within` is a column with the number of
    characters of the cleaned text that a token must end in, `types` are the types of content tokens. With `types`, word
    forms without a particle are left out too.
    """
    entries = word_list(computed_once(lexicon, "lexicon"))
    small = rows_if_small(entries, max_in_plan)
    words = _words(F.col(text_col), letters)
    if within is not None:
        words = let(words, lambda words: _first_words(words, F.col(within)))
    if small is not None:
        known = {row.word: {"type": row.token_type, "particle": "/J_" in row.piece} for row in small}
        unlisted = F.struct(*[F.lit(value).alias(name) for name, value in _UNLISTED.items()])
        found = F.transform("_words", lambda word: lookup(word, known, _ENTRY, unlisted))
        return _with_placed_tokens(rows.withColumn("_words", words), out_col, found, types)
    joined = _looked_up(rows, words, entries, F.struct(F.col("word"), _entry(F.col("token_type"), F.col("piece")).alias("entry")))
    return _with_placed_tokens(joined.withColumn("_words", F.col("_found.word")), out_col, F.col("_found.entry"), types).drop("_found")


def with_content_words(
    rows: DataFrame, words_col: str, lexicon: DataFrame, out_col: str, stop_types: Sequence[str] = STOP_TYPES, max_in_plan: int = PLAN_ROWS
) -> DataFrame:
    """Add the content word of each word of the array `words_col`, in order.

    It is the word itself, or '' where the word list gives the word a type that carries none.
    """
    stops = word_list(computed_once(lexicon, "lexicon")).where(F.col("token_type").isin(*stop_types)).select("word", F.lit("").alias("empty"))
    small = rows_if_small(stops, max_in_plan)
    if small is not None:
        empty = {row.word: "" for row in small}
        return rows.withColumn(out_col, F.transform(words_col, lambda word: lookup(word, empty, "string", word)))
    joined = _looked_up(rows, F.col(words_col), stops, F.coalesce("empty", "word"))
    return joined.withColumn(out_col, F.when(F.col(words_col).isNotNull(), F.col("_found"))).drop("_found")
