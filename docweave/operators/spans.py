"""Causes of a document, the span of text that belongs to each, and the verbs found in it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docweave.bounds import dealt_by_bytes
from docweave.functions.dictionary import let, sums_before
from docweave.functions.text import dictionary_form
from docweave.operators.lookup import best_match, emotion_dictionary, exact_lookup
from docweave.operators.payload import MATCHING_PAYLOAD, parse

VERB_TYPES = ("VV", "VA", "XR")
KEPT_TYPES = (*VERB_TYPES, "NNG")


def cause_spans(docs: DataFrame, keys: Sequence[str], body_col: str = "JSON") -> DataFrame:
    """One row per (result, variable), in order of start offset, with the length of its span.

    A span ends where the document's next cause starts, the last one where its sentence ends. A document's
    causes stay inside its row, so sorting them needs no shuffle. Each cause repeats the keys and the other columns, which
    may hold whole texts, so documents are dealt to partitions whose different texts fit a Parquet dictionary.
    """
    results = F.coalesce(parse(F.col(body_col), MATCHING_PAYLOAD)["result"], F.array().cast(
        "array<struct<sentence:struct<string:string>,matched_text:struct<string:string,begin:int>,"
        "variables:array<struct<value:string>>>>"
    ))

    def causes_of(result: Column, result_idx: Column) -> Column:
        return F.transform(
            result["variables"],
            lambda variable, var_idx: F.struct(
                F.ceil(result["matched_text"]["begin"] / 2).cast("int").alias("start"),
                result_idx.alias("result_idx"),
                var_idx.alias("var_idx"),
                variable["value"].alias("value"),
                result["matched_text"]["string"].alias("matched_text"),
                F.char_length(result["sentence"]["string"]).alias("sentence_length"),
            ),
        )

    def with_next(causes: Column) -> Column:
        return F.transform(
            causes, lambda c, i: F.struct(c.alias("cause"), F.get(causes, i + 1)["start"].alias("next"))
        )

    causes = F.array_sort(F.flatten(F.transform(results, causes_of)))
    others = [name for name in docs.columns if name != body_col and name not in keys]
    return (
        dealt_by_bytes(docs, [*keys, *others])
        .select(*keys, *others, F.posexplode(let(causes, with_next)).alias("cause_idx", "_item"))
        .select(*keys, *others, "cause_idx", "_item.cause.*", "_item.next")
        .withColumn("span", F.coalesce("next", "sentence_length") - F.col("start"))
        .drop("next")
    )


def described_tokens(tokens: Column, span: Column) -> Column:
    """Tokens inside [0, span) that belong to the cause.

    After a word with a particle, tokens at other positions describe something else and are passed over: a token is
    kept if no word with a particle came before it, or if its own word is one. Tokens are in order of position, a word's
    form before its other tokens, of which it may have any number.
    """

    def opens(token: Column) -> Column:
        return (token["type"] == "EOJEOL") & token["particle"]

    # Tokens that neither open a word nor can be kept do not change the outcome.
    relevant = F.filter(
        tokens,
        lambda t: (t["start_offset"] >= 0) & (t["start_offset"] < span)
        & (t["end_offset"] - 1 >= 0) & (t["end_offset"] - 1 < span)
        & (t["type"].isin(*KEPT_TYPES) | opens(t)),
    )

    def kept(tokens: Column) -> Column:
        # The words that open a stretch before each token, by number; the last of them is the token's own or an earlier one.
        earlier = sums_before(F.transform(tokens, lambda t: F.when(opens(t), 1).otherwise(0)))

        def of_open(opening: Column, earlier: Column) -> Column:
            def stays(token: Column, i: Column) -> Column:
                n = F.get(earlier, i)
                own = F.get(opening, n - 1) == token["position"]
                return ~opens(token) & ((n == 0) | F.coalesce(own, F.lit(False)))

            return F.filter(tokens, stays)

        opening = F.transform(F.filter(tokens, opens), lambda t: t["position"])
        after_open = lambda opening: let(earlier, lambda earlier: of_open(opening, earlier))
        return let(opening, lambda opening: F.when(F.size(opening) == 0, tokens).otherwise(after_open(opening)))

    items = let(relevant, kept)
    return F.transform(items, lambda t: F.struct(t["token"].alias("token"), t["type"].alias("type")))


def last_per_token(kept: Column) -> Column:
    """Keep the last entry of every distinct token, in order. Two sorts instead of a search for each entry, if any is repeated."""
    def last_ones(items: Column) -> Column:
        return F.filter(items, lambda item, i: F.coalesce(F.get(items, i + 1)["token"] != item["token"], F.lit(True)))

    def sorted_out(kept: Column) -> Column:
        placed = F.transform(kept, lambda item, i: F.struct(item["token"].alias("token"), i.alias("i"), item["type"].alias("type")))
        by_place = F.array_sort(
            F.transform(let(F.array_sort(placed), last_ones), lambda item: F.struct(item["i"].alias("i"), item["token"].alias("token"), item["type"].alias("type")))
        )
        return F.transform(by_place, lambda item: F.struct(item["token"].alias("token"), item["type"].alias("type")))

    unlike = lambda kept: F.size(F.array_distinct(F.transform(kept, lambda item: item["token"]))) == F.size(kept)
    return let(kept, lambda kept: F.when(unlike(kept), kept).otherwise(sorted_out(kept)))


def cause_verbs(
    causes: DataFrame,
    verb_dict: DataFrame,
    analyse: Callable[[DataFrame, str, str], DataFrame],
    keys: Sequence[str],
) -> DataFrame:
    """One row per distinct verb, adjective, root or noun of a cause, with its emotion.

    `analyse` adds the analyser tokens of a text column as a new column, both given by name. It is given the causes whose span
    is not empty: no token lies inside an empty one. Verbs, adjectives and roots are looked up exactly in their dictionary
    form, nouns by shared tokens.
    """
    causes = causes.where(F.col("span") > 0)
    kept = last_per_token(described_tokens(F.col("_tokens"), F.col("span")))
    named = [*keys, "cause_idx", "value"]
    # As a column of its own the array is exploded in generated code, which copies the keys less often. Without the outer form
    # Spark would test its size in a filter and make it twice.
    listed = analyse(causes, "matched_text", "_tokens").select(*named, kept.alias("_kept"))
    items = listed.select(*named, F.posexplode_outer("_kept").alias("verb_idx", "_item")).where(F.col("verb_idx").isNotNull())
    rows = items.select(*named, "verb_idx", F.col("_item.token").alias("verb"), F.col("_item.type").alias("_type"))
    dictionary = emotion_dictionary(verb_dict)
    is_verb = F.col("_type").isin(*VERB_TYPES)
    form = dictionary_form(F.col("verb"), F.col("_type"))
    found = exact_lookup(rows, F.when(is_verb, form), dictionary, "_exact")
    found = best_match(found, F.when(~is_verb, F.col("verb")), dictionary, "_matched")
    return found.withColumn("emotion", F.concat("_exact", "_matched")).drop("_type", "_exact", "_matched")
