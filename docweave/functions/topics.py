"""Topic words of tagged text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docweave.functions.tags import TOPIC_NOUN_TAGS, TOPIC_VERB_TAGS
from docweave.functions.text import strip_tags


def _joined(word: Column, tag: str) -> Column:
    """Surfaces of the word's morphemes that carry `tag`."""
    carrying = F.filter(F.split(word, r"\+", -1), lambda morpheme: F.contains(morpheme, F.lit(f"/{tag}")))
    return F.array_join(F.transform(carrying, strip_tags), "")


def _topic(word: Column) -> Column:
    has = lambda tag: F.contains(word, F.lit(f"/{tag}"))
    stem = strip_tags(F.substring_index(word, "/XSV", 1))
    topic = F.when(~has("NNG") & has("XSV"), F.concat(stem, F.lit("다")))
    for tag in TOPIC_NOUN_TAGS:
        topic = topic.when(has(tag), _joined(word, tag))
    for tag in TOPIC_VERB_TAGS:
        topic = topic.when(has(tag), F.concat(_joined(word, tag), F.lit("다")))
    return topic


def topic_words(tagged: Column) -> Column:
    """One topic word per word of the text that has one; the first matching tag decides."""
    return F.filter(F.transform(F.split(tagged, " ", -1), _topic), lambda topic: topic.isNotNull())
