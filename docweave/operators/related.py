"""Words that occur close to a phrase in one document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docweave.bounds import fits
from docweave.functions import text as T
from docweave.functions.dictionary import let
from docweave.functions.tags import STOP_TYPES
from docweave.operators.tagging import with_content_words

# Size and number of fragments.
FRAGMENT_SIZE = 30
MAX_FRAGMENTS = 5


def content_tokens(tokens: Column, stop_types: Sequence[str] = STOP_TYPES) -> Column:
    """Analyser tokens whose type carries content."""
    return F.filter(tokens, lambda token: ~token["type"].isin(*stop_types))


def content_word(tokens: Column, stop_types: Sequence[str] = STOP_TYPES) -> Column:
    """Content tokens joined to one word, '' if there is none."""
    return F.array_join(F.transform(content_tokens(tokens, stop_types), lambda token: token["token"]), "")


def _placed_words(text: Column, fragment_size: int) -> Column:
    """Words of the text in order, each with the ordinal of the fragment that holds it."""
    return F.flatten(
        F.transform(
            T.fragments(text, fragment_size),
            lambda fragment, idx: F.transform(
                T.tokens(fragment), lambda word: F.struct(idx.alias("fragment"), word.alias("word"))
            ),
        )
    )


def _close_words(placed: Column, phrase: Column, fragment_limit: int, attached: bool) -> Column:
    """Words of the first fragments with a hit, the hit itself left out."""
    width = F.greatest(F.size(phrase), F.lit(1))
    first, last = F.get(phrase, F.lit(0)), F.get(phrase, width - 1)

    def hits_in(words: Column) -> Column:
        def opens(word: Column, i: Column) -> Column:
            end = F.get(words, i + width - 1)
            ends = F.startswith(end, last) if attached else end == last
            same = F.slice(words, i + 1, width - 1) == F.slice(phrase, F.lit(1), width - 1)
            return F.startswith(word, first) & F.coalesce(ends, F.lit(False)) & same

        starts = F.filter(F.transform(words, lambda word, i: F.when(opens(word, i), i)), lambda i: i.isNotNull())
        return F.array_distinct(F.flatten(F.transform(starts, lambda i: F.sequence(i, i + width - 1))))

    def shown(hits: Column) -> Column:
        fragments = F.array_distinct(F.transform(hits, lambda i: F.get(placed, i)["fragment"]))
        return F.slice(fragments, 1, fragment_limit)

    def close(hits: Column) -> Column:
        words = let(
            shown(hits),
            lambda fragments: F.filter(
                placed, lambda item, i: F.array_contains(fragments, item["fragment"]) & ~F.array_contains(hits, i)
            ),
        )
        return F.transform(words, lambda item: item["word"])

    words = F.transform(placed, lambda item: item["word"])
    return let(let(words, hits_in), close)


def related_words(
    requests: DataFrame,
    docs: DataFrame,
    lexicon: DataFrame | None = None,
    fragment_size: int = FRAGMENT_SIZE,
    fragment_limit: int = MAX_FRAGMENTS,
    attached: bool = False,
) -> DataFrame:
    """Related words of every (doc_id, term) request, in order of first occurrence.

    The term is looked for as a phrase in title and content. Words of the first hit fragments of the title
    come before those of the content. Words that a `lexicon` gives a type without content are left out. With `attached`,
    letters that follow the phrase's last word belong to the hit.
    """
    asked = requests.select("doc_id", "term")
    wanted = F.broadcast(asked.distinct()) if fits(asked) else asked.distinct()
    joined = docs.select("doc_id", "doc_title", "doc_content").join(wanted, "doc_id")
    phrase = T.tokens(F.col("term"))

    def words_of(field: str, phrase: Column) -> Column:
        placed = _placed_words(F.coalesce(field, F.lit("")), fragment_size)
        return let(placed, lambda words: _close_words(words, phrase, fragment_limit, attached))

    words = let(phrase, lambda p: F.concat(words_of("doc_title", p), words_of("doc_content", p)))
    joined = joined.select("doc_id", "term", words.alias("_close"))
    if lexicon is not None:
        joined = with_content_words(joined, "_close", lexicon, "_close")
    kept = F.filter(F.array_distinct("_close"), lambda word: F.char_length(word) > 1)
    return joined.select("doc_id", "term", F.posexplode(kept).alias("word_order", "word"))
