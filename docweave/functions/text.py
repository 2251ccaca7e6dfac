"""Column functions over plain and tagged text. All of them stay inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from docweave.functions import tags
from docweave.functions.tags import KOREAN, Letters

# Unicode white space, spelled out because Java's \s covers ASCII only.
BLANK = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
TOKEN = r"[\p{L}\p{N}]+"
NOT_TOKEN = r"[^\p{L}\p{N}]+"


def strip(text: Column) -> Column:
    """Drop Unicode white space at both ends."""
    return F.btrim(text, F.lit(BLANKS))


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def _class_parts(body: str) -> tuple[str, str]:
    """The class `[body]` of plain characters and ranges, split into characters below 256 and ranges above."""
    found = re.findall(r"(.)-(.)|(.)", body, re.DOTALL)
    ranges = [(ord(first or single), ord(last or single)) for first, last, single in found]
    low = "".join(f"\\x{code:02x}" for first, last in ranges for code in range(first, min(last, 255) + 1))
    high = "".join(f"[\\x{{{max(first, 256):x}}}-\\x{{{last:x}}}]" for first, last in ranges if last > 255)
    return low, high


# Java tests the ranges of a class one by one, which is slow for long classes. In the patterns below one table
# look-up answers for characters below 256, and only the others are held against the ranges.
_ABOVE = r"(?=[\x{100}-\x{10ffff}])"


def outside(body: str) -> str:
    """A pattern for one character that is not in the class `[body]`."""
    low, high = _class_parts(body)
    others = "".join(f"(?!{part}])" for part in high.split("]") if part)
    return rf"(?s:[\x00-\xff&&[^{low}]]|{_ABOVE}{others}.)"


def only(body: str) -> str:
    """A pattern for a whole text of characters of the class `[body]`, which should have few ranges above 255."""
    low, high = _class_parts(body)
    return rf"\A[{low}{high}]*+\z"


def inside(body: str) -> str:
    """A pattern for one character of the class `[body]`."""
    low, high = _class_parts(body)
    return rf"(?:[{low}]|{_ABOVE}[{high}])"


# A whole text of spaces, Hangul syllables and printable characters below 256. It holds no other blank and no single Hangul
# letter, so spaces are all there is to strip and nothing has to be composed.
PLAIN = r"\A[\x20-\x7e\xa1-\xff가-힣]*+\z"


def without_line_breaks(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r")), F.lit("\n"))


def clean_id(text: Column) -> Column:
    return F.translate(text, "\r\n ", "")


def sentences(text: Column, sentence_end: str = tags.SENTENCE_END) -> Column:
    """The pieces between sentence ends, blank ones included so that ordinals stay stable."""
    return F.split(text, sentence_end, -1)


def blank_punctuation(text: Column) -> Column:
    """Replace punctuation by a space, as is done before tagging."""
    return F.regexp_replace(strip(F.replace(text, F.lit("\r\n"))), tags.PUNCTUATION, " ")


def keep_letters(text: Column, letters: Letters = KOREAN) -> Column:
    """Keep letters, digits and white space, then drop line breaks and outer blanks."""
    kept = F.regexp_replace(text, outside(letters.kept + BLANKS), "")
    return strip(without_line_breaks(kept))


def tagger_input(text: Column, letters: Letters = KOREAN) -> Column:
    return keep_letters(blank_punctuation(text), letters)


def strip_tags(tagged: Column) -> Column:
    return F.regexp_replace(tagged, tags.TAG, "")


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def padded(text: Column) -> Column:
    """Tokens joined by single spaces, with a space at both ends."""
    joined = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOT_TOKEN, " "))
    return F.concat(F.lit(" "), joined, F.lit(" "))


def padded_tokens(padded_text: Column) -> Column:
    return F.split(F.btrim(padded_text), " ", -1)


def holds_phrase(padded_text: Column, padded_phrase: Column) -> Column:
    """Whether the phrase occurs as consecutive whole tokens; both sides come from `padded`."""
    return F.contains(padded_text, padded_phrase)


def corpus_line(tagged: Column) -> Column:
    """Morphemes of tagged text, each followed by a space."""
    return F.concat(F.array_join(F.split(tagged, rf"[{BLANK}+]", -1), " "), F.lit(" "))


def close_words(fragment: Column, letters: Letters = KOREAN) -> Column:
    """Words around the <em> marks, without the marked words and the letters attached to them.

    A mark that holds a digit is not recognised, so its markup is split into words like other text.
    """
    # Fixed value: the pattern of a mark.
    mark = f"<em>[{letters.highlighted}{BLANK}]*</em>[{letters.highlighted}]*"
    rest = F.split(fragment, mark, -1)
    words = F.flatten(F.transform(rest, lambda part: F.split(part, outside(letters.word), -1)))
    return F.filter(words, lambda word: word != "")


def fragments(text: Column, size: int = 30) -> Column:
    """Cut text into pieces of `size` characters, each run on to the end of the word it stops in."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{size}}}[\p{{L}}\p{{N}}]*"), F.lit(0))


def dictionary_form(token: Column, token_type: Column) -> Column:
    """Verbs and adjectives end in -다, roots in -하다; other tokens stay as they are."""
    surface = F.split_part(token, F.lit("/"), F.lit(1))
    return (
        F.when(token_type.isin("VV", "VA"), F.concat(surface, F.lit("다")))
        .when(token_type == "XR", F.concat(surface, F.lit("하다")))
        .otherwise(token)
    )
