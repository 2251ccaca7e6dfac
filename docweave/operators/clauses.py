"""Documents to sentences, sentences to clauses, clauses to (subject, verb, sentiment, category) rows.

Rows are keyed by the document key and the ordinals `sentence_idx`, `clause_idx` and `attr_idx`. Every step
works inside the row, so nothing is shuffled as long as the dictionaries pass their size checks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docweave.functions import tags, text as T
from docweave.functions.dictionary import let
from docweave.functions.hangul import compose_jamo
from docweave.operators.lookup import best_match, category_dictionary, emotion_dictionary, exact_lookup


def split_sentences(
    docs: DataFrame, keys: Sequence[str], text_col: str, sentence_end: str = tags.SENTENCE_END
) -> DataFrame:
    """One row per sentence that is not blank; `sentence_idx` counts blank ones too."""
    pieces = F.transform(T.sentences(F.col(text_col), sentence_end), T.strip)
    return docs.select(*keys, F.posexplode(pieces).alias("sentence_idx", "sentence")).where(F.col("sentence") != "")


def split_clauses(tagged: DataFrame, text_col: str = "sentence", kma_col: str = "sentence_kma") -> DataFrame:
    """One row per clause: the tagged text is split after every connective ending.

    A clause without text is left out. A sentence that has no other keeps one row with nulls.
    """
    others = [name for name in tagged.columns if name != kma_col]

    def with_text(parts: Column) -> Column:
        whole = T.blank_punctuation(F.col(text_col))
        clauses = F.transform(
            parts,
            lambda part, idx: F.struct(
                idx.alias("clause_idx"),
                part.alias("clause_kma"),
                F.when(F.size(parts) == 1, whole)
                .when(part.rlike(T.PLAIN), F.trim(T.strip_tags(part)))
                .otherwise(T.strip(compose_jamo(T.strip_tags(part)))).alias("clause"),
            ),
        )
        return F.filter(clauses, lambda clause: clause["clause"] != "")

    clauses = let(F.split(F.col(kma_col), tags.CLAUSE_MARK, -1), with_text)
    return tagged.select(*others, F.explode_outer(clauses).alias("_clause")).select(*others, "_clause.*")


def _plain(tagged: Column) -> Column:
    return compose_jamo(T.strip_tags(T.strip(tagged)))


def subject_part(kma: Column) -> Column:
    """The text before the last particle, or null when no particle occurs."""
    return _before_last(F.split(kma, tags.PARTICLE, -1))


def _before_last(parts: Column) -> Column:
    return F.get(parts, F.size(parts) - 2)


def split_conjuncts(subject: Column) -> Column:
    """Coordinated subjects, one array element each; an empty conjunct stays as ''."""
    conjuncts = F.split(subject, tags.CONJUNCTION, -1)
    plain = F.transform(conjuncts, lambda part: F.trim(T.strip_tags(part)))
    return F.when(subject.rlike(T.PLAIN), plain).otherwise(
        F.transform(conjuncts, lambda part: T.strip(compose_jamo(T.strip_tags(part))))
    )


def _is_verb(word: Column) -> Column:
    found = F.contains(word, F.lit(tags.VERB_TAGS[0]))
    for tag in tags.VERB_TAGS[1:]:
        found = found | F.contains(word, F.lit(tag))
    return found


# A word with the space before it, if it is a verb or if it is none.
_VERB_WORD = f" [^ ]*(?:{'|'.join(tags.VERB_TAGS)})[^ ]*"
_OTHER_WORD = f" (?![^ ]*(?:{'|'.join(tags.VERB_TAGS)}))[^ ]*"


def add_subjects_and_verb(clauses: DataFrame, kma_col: str = "clause_kma", verb_part: str = "as_written") -> DataFrame:
    """Add `n_parts`, `subjects` and `verb`; all subjects of a clause share its verb.

    With one particle the verb follows it. With more, `verb_part` picks the text after the first particle
    (`as_written`) or after the last one (`last`).
    """
    # Both are used several times, so they are columns until the end.
    clauses = clauses.withColumns({"_parts": F.split(F.col(kma_col), tags.PARTICLE, -1), "_is_plain": F.col(kma_col).rlike(T.PLAIN)})
    kma, parts, is_plain = F.col(kma_col), F.col("_parts"), F.col("_is_plain")
    words = F.split(kma, " ", -1)
    chosen = {"as_written": F.get(parts, F.lit(1)), "last": F.get(parts, F.size(parts) - 1)}[verb_part]

    def plain_words(chosen: Column) -> Column:
        """Plain forms with a space before each; tags and letters never reach across a space."""
        joined = compose_jamo(T.strip_tags(F.array_join(F.transform(chosen, T.strip), " ")))
        return F.when(F.size(chosen) > 0, F.concat(F.lit(" "), joined)).otherwise("")

    def without(words: str) -> Column:
        """The same for plain text, in which words have no blanks to strip: the other words are cut out."""
        return T.strip_tags(F.regexp_replace(F.concat(F.lit(" "), kma), words, ""))

    verb_words = F.when(is_plain, without(_OTHER_WORD)).otherwise(let(F.filter(words, _is_verb), plain_words))
    noun_words = F.when(is_plain, without(_VERB_WORD)).otherwise(let(F.filter(words, lambda word: ~_is_verb(word)), plain_words))
    # The text before the first space is no noun.
    nouns = let(F.split(noun_words, " ", -1), lambda list_: F.slice(list_, F.lit(2), F.size(list_)))
    after = F.when(is_plain, T.strip_tags(F.trim(chosen))).otherwise(_plain(chosen))
    no_particle = F.size(parts) == 1
    return clauses.select(
        "*",
        F.size(parts).alias("n_parts"),
        F.when(no_particle, verb_words).otherwise(after).alias("verb"),
        F.when(no_particle, nouns).otherwise(split_conjuncts(_before_last(parts))).alias("subjects"),
    ).drop("_parts", "_is_plain")


def clause_label(sentiments: Column) -> Column:
    """Negative wins over positive, positive over neutral; other labels count as neutral."""
    has = lambda label: F.exists(sentiments, lambda s: T.strip(s) == label)
    return (
        F.when(has(tags.NEGATIVE), tags.NEGATIVE).when(has(tags.POSITIVE), tags.POSITIVE).otherwise(tags.NEUTRAL)
    )


def analysed_clauses(tagged: DataFrame, verb_dict: DataFrame, verb_part: str = "as_written") -> DataFrame:
    """Clauses with `subjects`, `verb` and the verb's sentiment, looked up once per clause."""
    clauses = add_subjects_and_verb(split_clauses(tagged), verb_part=verb_part)
    return best_match(clauses, F.col("verb"), emotion_dictionary(verb_dict), "sentiment")


def clause_sentiments(tagged: DataFrame, verb_dict: DataFrame, verb_part: str = "as_written") -> DataFrame:
    """One label per clause. Subjects share the verb's sentiment, so no grouping is needed."""
    clauses = analysed_clauses(tagged, verb_dict, verb_part)
    shared = F.array(F.col("sentiment"))
    label = F.when(F.size("subjects") > 0, let(shared, clause_label)).otherwise(tags.NEUTRAL)
    return clauses.withColumn("clause_sentiment", F.when(F.col("clause_idx").isNotNull(), label))


def extract_attributes(
    tagged: DataFrame, verb_dict: DataFrame, category: DataFrame, verb_part: str = "as_written", keep_empty: bool = False
) -> DataFrame:
    """One row per subject. A sentence without clauses keeps one row with nulls; with `keep_empty` a clause without
    subjects does so too.

    Subjects of clauses with a particle are matched by shared tokens, the others exactly.
    """
    clauses = analysed_clauses(tagged, verb_dict, verb_part)
    others = [name for name in clauses.columns if name not in ("subjects", "verb", "sentiment")]
    rows = clauses.select(*others, "verb", "sentiment", F.posexplode_outer("subjects").alias("attr_idx", "subject"))
    has_subject = F.col("attr_idx").isNotNull()
    if not keep_empty:
        rows = rows.where(has_subject | F.col("clause_idx").isNull())
    categories = category_dictionary(category)
    exact = F.when(F.col("n_parts") == 1, F.col("subject"))
    matched = F.when(F.col("n_parts") > 1, F.col("subject"))
    found = best_match(exact_lookup(rows, exact, categories, "_exact"), matched, categories, "_matched")
    return found.select(
        *others,
        "attr_idx",
        "subject",
        F.when(has_subject, F.col("verb")).alias("verb"),
        F.when(has_subject, F.col("sentiment")).alias("sentiment"),
        F.when(has_subject, F.concat("_exact", "_matched")).alias("category"),
    )
