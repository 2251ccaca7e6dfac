"""Recomposition of Hangul that a tagger has taken apart into single letters."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docweave.functions.dictionary import let

# Fixed values of the Unicode Hangul block: letters in composition order.
LEADS = "ㄱㄲㄴㄷㄸㄹㅁㅂㅃㅅㅆㅇㅈㅉㅊㅋㅌㅍㅎ"
VOWELS = "ㅏㅐㅑㅒㅓㅔㅕㅖㅗㅘㅙㅚㅛㅜㅝㅞㅟㅠㅡㅢㅣ"
TAILS = "ㄱㄲㄳㄴㄵㄶㄷㄹㄺㄻㄼㄽㄾㄿㅀㅁㅂㅄㅅㅆㅇㅈㅊㅋㅌㅍㅎ"
FIRST_SYLLABLE = 0xAC00
TAIL_SLOTS = len(TAILS) + 1
LEAD_SLOTS = len(VOWELS) * TAIL_SLOTS

# Single letters are ㄱ-ㅎ (with the clusters below, which close a syllable only) and ㅏ-ㅣ.
_CLUSTERS = "ㄳㄵㄶㄺ-ㅀㅄ"
_LEADS_ONLY = "ㄸㅃㅉ"
# A letter that could also open the next syllable is a tail only if no vowel follows it.
_UNIT = (
    rf"[ㄱ-ㅎ](?=[ㅏ-ㅣ])(?<![{_CLUSTERS}])[ㅏ-ㅣ]"
    rf"(?:[ㄱ-ㅎ](?<![{_LEADS_ONLY}])(?:(?![ㅏ-ㅣ])|(?<=[{_CLUSTERS}])))?|."
)
_HAS_LETTER = "[ㄱ-ㅣ]"
# Single letters with the syllable before them, and what stands between such pieces.
_PIECE = r"[가-힣]?[ㄱ-ㅣ]+|[^ㄱ-ㅣ]+?(?=[가-힣]?[ㄱ-ㅣ]|\z)"


def _letter(letters: str, index: Column) -> Column:
    """The letter at a place that is known to exist."""
    return F.get(F.split(F.lit(letters), ""), index)


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by)).cast("int")


def _decompose(char: Column) -> Column:
    code = F.ascii(char) - FIRST_SYLLABLE
    tail = F.pmod(code, F.lit(TAIL_SLOTS))
    letters = F.concat(
        _letter(LEADS, _div(code, LEAD_SLOTS)),
        _letter(VOWELS, _div(F.pmod(code, F.lit(LEAD_SLOTS)), TAIL_SLOTS)),
        F.when(tail > 0, _letter(TAILS, tail - 1)).otherwise(F.lit("")),
    )
    return F.when(char.between("가", "힣"), letters).otherwise(char)


def _compose(unit: Column) -> Column:
    code = (
        F.lit(FIRST_SYLLABLE)
        + (F.instr(F.lit(LEADS), F.substring(unit, 1, 1)) - 1) * LEAD_SLOTS
        + (F.instr(F.lit(VOWELS), F.substring(unit, 2, 1)) - 1) * TAIL_SLOTS
        + F.when(F.char_length(unit) > 2, F.instr(F.lit(TAILS), F.substring(unit, 3, 1))).otherwise(0)
    )
    return F.when(F.char_length(unit) > 1, F.decode(F.unhex(F.hex(code)), "UTF-16BE")).otherwise(unit)


def _recompose(piece: Column) -> Column:
    """A piece of letters that a syllable may open."""
    first = let(F.substring(piece, 1, 1), _decompose)
    letters = F.concat(first, F.substring(piece, F.lit(2), F.char_length(piece)))
    return F.array_join(F.transform(F.regexp_extract_all(letters, F.lit(_UNIT), F.lit(0)), _compose), "")


def compose_jamo(text: Column) -> Column:
    """Take every syllable apart into letters, then put the letters together again.

    A syllable whose next character is no single letter comes back unchanged: what it opens with is followed by its own
    vowel, so nothing before can take it. So only single letters and the syllable before them are worked on.
    """

    def by_piece(text: Column) -> Column:
        pieces = F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0))
        fixed = F.transform(pieces, lambda piece: F.when(piece.rlike(_HAS_LETTER), _recompose(piece)).otherwise(piece))
        return F.when(text.rlike(_HAS_LETTER), F.array_join(fixed, "")).otherwise(text)

    return let(text, by_piece)
