"""Fixed values of the tagged-text format, and the letter classes that differ by language."""

from __future__ import annotations

from dataclasses import dataclass

# Patterns of the tagged text (`surface/TAG`, morphemes joined by `+`, words by a space).
# Classes of single syllables are held against the range of Hangul first, which answers for other letters at once.
CLAUSE_MARK = "/EM "
PARTICLE = r"[가-힣&&[은는이가도]]/J_"
CONJUNCTION = r"[가-힣&&[와과및]]+/[(J_|MA)]+"
TAG = r"/[A-Z]+[_]*[\+]*"
VERB_TAGS = ("/VA", "/VV", "/XSD", "/EM")

# Sentence ends, and the punctuation blanked before tagging.
SENTENCE_END = "[.]"
SENTENCE_END_MULTI = r"[.\-_~^?!]+"
PUNCTUATION = r"[.!_+*&^%$#@`~:;,，]"

# Token types that do not carry content.
STOP_TYPES = (
    "COMPOUND", "EOJEOL", "INFLECT", "VV", "VA", "VX", "VCP", "VCN", "NNB", "E", "JKS", "JKC", "JKG", "JKO", "JKB", "JKV",
    "JKQ", "JX", "JC", "EP", "EF", "EC", "ETN", "ETM", "XPN", "XSN", "XSV", "XSA", "SF", "SE", "SS", "SN", "SP", "SO", "SW", "SH",
)

# Noun-like tags that make a topic word, in order of preference.
TOPIC_NOUN_TAGS = ("NNG", "NNP", "SL", "NFU", "NFG", "FL")
TOPIC_VERB_TAGS = ("VV", "VA")

# Sentiment labels.
POSITIVE = "긍정"
NEGATIVE = "부정"
NEUTRAL = "중립"


@dataclass(frozen=True)
class Letters:
    """Bodies of the regex classes that decide which characters belong to a word."""

    kept: str = "가-힣a-zA-Z0-9"
    highlighted: str = "가-힣ㄱ-ㅎa-zA-Z"
    word: str = "가-힣ㄱ-ㅎㅏ-ㅣa-zA-Z0-9"

    def plus(self, ranges: str) -> Letters:
        return Letters(self.kept + ranges, self.highlighted + ranges, self.word + ranges)


KOREAN = Letters()
KOREAN_AND_LATIN = KOREAN.plus("À-ÖØ-öø-ÿ")
