"""The jobs a user runs: each takes tables and returns a DataFrame ready to be written."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from docweave.functions import tags, text as T
from docweave.functions.tags import KOREAN, Letters
from docweave.functions.topics import topic_words
from docweave.operators import clauses, payload, spans
from docweave.operators.tagging import tag_sentences, with_word_tokens
from docweave.sinks.rows import index_document, joined_id, tagged_record
from docweave.sources.files import SURVEY_COLUMNS

SURVEY_KEYS = SURVEY_COLUMNS[:4]


def tagged_sentences(
    docs: DataFrame,
    lexicon: DataFrame,
    keys: Sequence[str],
    text_col: str,
    sentence_end: str = tags.SENTENCE_END,
    letters: Letters = KOREAN,
) -> DataFrame:
    """Sentences of the documents with their tagged form."""
    sentences = clauses.split_sentences(docs, keys, text_col, sentence_end)
    return tag_sentences(sentences, lexicon, [*keys, "sentence_idx"], letters=letters)


def attribute_rows(tagged: DataFrame, verb_dict: DataFrame, category: DataFrame, carried: Sequence[str] = (), **options) -> DataFrame:
    """Seven output columns after the ordinals: a sentence's clause, subject, verb, sentiment and category.

    Here and below, `carried` names columns of the input that come first, such as the file a row was read from.
    """
    rows = clauses.extract_attributes(tagged, verb_dict, category, **options)
    return rows.select(
        *carried, "doc_id", "sentence_idx", "clause_idx", "attr_idx", "sentence", F.col("clause_kma").alias("sentence_kma"),
        "subject", "verb", "sentiment", "category",
    )


def clause_documents(tagged: DataFrame, verb_dict: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """One JSON document per clause, with an id that is unique within the document."""
    rows = clauses.clause_sentiments(tagged, verb_dict).where(F.col("clause_idx").isNotNull())
    source = {
        "sentence": F.col("sentence"), "sentence_kma": F.col("clause_kma"), "sentiment": F.col("clause_sentiment"),
    }
    doc_id = joined_id("doc_id", "sentence_idx", "clause_idx")
    return rows.select(*carried, doc_id.alias("id"), index_document(doc_id, source).alias("document"))


def survey_sentences(survey: DataFrame, lexicon: DataFrame, letters: Letters = KOREAN, carried: Sequence[str] = ()) -> DataFrame:
    """Tagged sentences of the comments. The comment travels with its sentences instead of being joined back."""
    keyed = survey.withColumn("content", F.col("comment"))
    return tagged_sentences(
        keyed, lexicon, [*carried, *SURVEY_KEYS, "content"], "comment", tags.SENTENCE_END_MULTI, letters
    )


def survey_attributes(
    tagged: DataFrame, verb_dict: DataFrame, category: DataFrame, carried: Sequence[str] = (), **options
) -> DataFrame:
    """Eleven columns per attribute of a comment, and the ordinals that order them."""
    rows = clauses.extract_attributes(tagged, verb_dict, category, **options)
    return rows.select(
        *carried, *SURVEY_KEYS, T.strip(F.col("content")).alias("content"), "sentence_idx", "clause_idx", "clause",
        "attr_idx", "subject", "verb", "sentiment", "category",
    )


def survey_documents(tagged: DataFrame, verb_dict: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """One JSON document per clause of a comment; a sentence without clauses gives one with empty values."""
    rows = clauses.clause_sentiments(tagged, verb_dict)
    source = {
        "content": F.col("content"), "sentence": F.col("sentence"),
        "sentence_kma": F.coalesce("clause_kma", F.lit("")),
        "sentiment": F.coalesce("clause_sentiment", F.lit("")),
    }
    doc_id = joined_id(*SURVEY_KEYS, "sentence_idx", "clause_idx")
    return rows.select(*carried, doc_id.alias("id"), index_document(doc_id, source).alias("document"))


def tagged_records(
    tagged: DataFrame, verb_dict: DataFrame, category: DataFrame, date: str, content_col: str = "content", carried: Sequence[str] = ()
) -> DataFrame:
    """One record of the tagged format per attribute. `tagged` carries the document's content; `date` is yyyyMMdd.

    Each record holds the whole content, so Parquet of it belongs in a `session_for_repeated_texts`, or is written with zstd.
    """
    rows = clauses.extract_attributes(tagged, verb_dict, category).where(F.col("attr_idx").isNotNull())
    record_id = joined_id("doc_id", "sentence_idx", "clause_idx", "attr_idx")
    attributes = [F.col(name) for name in ("subject", "verb", "sentiment", "category")]
    return rows.select(*carried, record_id.alias("id"), tagged_record(record_id, date, F.col(content_col), attributes).alias("record"))


def corpus(records: DataFrame) -> DataFrame:
    """Corpus lines of raw records (DocId, Content, JSON)."""
    return payload.corpus_lines(payload.cleaned_records(records, strip_ends=True))


def cause_verbs(
    records: DataFrame,
    verb_dict: DataFrame,
    analyse: Callable[[DataFrame, str, str], DataFrame],
    keys: Sequence[str] = ("doc_id", "content"),
) -> DataFrame:
    """Verbs and nouns per cause of cleaned records, with their emotions. `keys` are repeated on every row.

    `analyse` adds analyser tokens: `cause_analyser` of a word list, or anything else that gives such tokens.
    """
    return spans.cause_verbs(spans.cause_spans(records, keys), verb_dict, analyse, keys)


def word_analyser(
    lexicon: DataFrame, letters: Letters = KOREAN, within: str | None = None, types: Sequence[str] | None = None
) -> Callable[[DataFrame, str, str], DataFrame]:
    """The analyser that looks words up in a word list of any size. `within` and `types` are those of `with_word_tokens`."""
    return lambda rows, text_col, out_col: with_word_tokens(rows, text_col, lexicon, out_col, letters, within=within, types=types)


def cause_analyser(lexicon: DataFrame, letters: Letters = KOREAN) -> Callable[[DataFrame, str, str], DataFrame]:
    """The word list's analyser for `cause_verbs`, which makes only tokens that can matter inside the causes' spans."""
    return word_analyser(lexicon, letters, "span", spans.KEPT_TYPES)


def topic_lists(rows: DataFrame, lexicon: DataFrame, keys: Sequence[str], text_col: str, letters: Letters = KOREAN) -> DataFrame:
    """Rows of a free sheet with the topic words of their text; a blank text has none."""
    line = rows.withColumn("_line", T.without_line_breaks(F.col(text_col)))
    tagged = tag_sentences(line, lexicon, keys, "_line", "_kma", letters)
    topics = F.when(F.col("_kma") == "", F.array().cast("array<string>")).otherwise(topic_words(F.col("_kma")))
    return tagged.select(*rows.columns, topics.alias("topics"))
