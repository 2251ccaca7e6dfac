"""Dictionary lookups: exact, and best match by shared tokens.

A dictionary has the columns `key`, `value`, `terms` (exact forms) and `words` (text to match against).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from docweave.bounds import PLAN_ROWS, broadcast_if_small, computed_once, rows_if_small
from docweave.functions.dictionary import let, lookup
from docweave.functions.text import tokens
from docweave.scratch import written_table

#: Tokens of more entries than this are hot: a text meets their entries only by way of distinct sets of such tokens.
HOT_ENTRIES = 1_000
#: Up to so many entries are counted for each text at once instead of being searched.
FEW_ENTRIES = 256
#: The first rounds of a search take so many tokens of a text, the next ones each so many times as many.
FIRST_TOKENS, MORE_TOKENS = 1, 4
POSTING = "array<struct<key:string,value:string>>"


def emotion_dictionary(verb_dict: DataFrame) -> DataFrame:
    return verb_dict.select(
        F.col("verb").alias("key"), F.col("emotion").alias("value"),
        F.array("verb").alias("terms"), F.col("verb").alias("words"),
    )


def category_dictionary(category: DataFrame) -> DataFrame:
    names = ["category_eng", "category_kor", "synonym"]
    return category.select(
        F.col("category_eng").alias("key"), F.col("subtopic_code").alias("value"),
        F.array(*names).alias("terms"), F.concat_ws(" ", *names).alias("words"),
    )


def exact_lookup(
    df: DataFrame, text: Column, dictionary: DataFrame, out_col: str, max_rows: int | None = None
) -> DataFrame:
    """Value of the first entry, by key, that has `text` among its terms; '' if there is none."""
    terms = (
        dictionary.select(F.explode("terms").alias("_term"), "key", "value")
        .where(F.col("_term") != "")
        .groupBy("_term")
        .agg(F.min(F.struct("key", "value")).alias("_first"))
        .select("_term", F.col("_first.value").alias("_found"))
    )
    bounded = broadcast_if_small(terms) if max_rows is None else broadcast_if_small(terms, max_rows)
    return (
        df.withColumn("_text", text)
        .join(bounded, F.col("_text") == F.col("_term"), "left")
        .withColumn(out_col, F.coalesce("_found", F.lit("")))
        .drop("_text", "_term", "_found")
    )


def _postings(dictionary: DataFrame) -> DataFrame:
    """The tokens of all entries, one row for each time that a token is in a row of an entry."""
    return dictionary.select("key", "value", F.explode(tokens(F.col("words"))).alias("token"))


def _best_in_row(text: Column, postings: dict[str, list[dict]]) -> Column:
    known = F.array_distinct(F.filter(tokens(text), lambda token: token.isin(list(postings))))
    none = F.array().cast(POSTING)
    entries_of = lambda known: F.flatten(F.transform(known, lambda token: lookup(token, postings, POSTING, none)))

    def best(hits: Column) -> Column:
        ranked = F.transform(
            F.array_distinct(hits),
            lambda hit: F.struct(
                (-F.size(F.filter(hits, lambda other: other == hit))).alias("score"), hit["key"].alias("key"),
                hit["value"].alias("value"),
            ),
        )
        return F.array_min(ranked)["value"]

    # Most texts hold no token of the dictionary.
    matched = lambda known: F.when(F.size(known) > 0, let(entries_of(known), best))
    return F.coalesce(let(known, matched), F.lit(""))


def best_match(
    df: DataFrame,
    text: Column,
    dictionary: DataFrame,
    out_col: str,
    max_in_plan: int = PLAN_ROWS,
    hot_entries: int = HOT_ENTRIES,
    few_entries: int = FEW_ENTRIES,
) -> DataFrame:
    """Value of the entry that shares most distinct tokens with `text`, the first key on a tie; '' if none does.

    An entry is a (key, value) with the tokens of all its rows. A dictionary of at most `max_in_plan` tokens is matched
    inside the row. A larger one is searched once per distinct set of tokens, which rows find again by
    its digest; if it has at most `few_entries`, all their scores are counted instead.
    """
    dictionary = computed_once(dictionary.select("key", "value", "words"), "dictionary")
    small = rows_if_small(_postings(dictionary), max_in_plan)
    if small is not None:
        index: dict[str, list[dict]] = {}
        for row in set(small):
            index.setdefault(row.token, []).append({"key": row.key, "value": row.value})
        return df.withColumn(out_col, _best_in_row(text, index) if index else F.lit(""))

    held = F.array_sort(F.array_distinct(tokens(text)))
    digest = F.when(F.size(held) > 0, F.md5(F.array_join(held, " ").cast("binary")))
    sets = df.select(digest.alias("_set"), held.alias("_tokens")).where(F.col("_set").isNotNull()).dropDuplicates(["_set"])
    best = _best_by_threshold(sets, dictionary, hot_entries, few_entries)
    return (
        df.withColumn("_digest", digest)
        .join(written_table(best, "best"), F.col("_digest") == F.col("_set"), "left")
        .withColumn(out_col, F.coalesce("_found", F.lit("")))
        .drop("_digest", "_set", "_found")
    )


def _unlike(postings: DataFrame) -> DataFrame:
    """Postings (token, _entry, size) of the first entry of each set of tokens; `size` is the number of its tokens.

    Entries with the same tokens tie for every text, so the first one stands for all. Sets are told apart by two hashes.
    """
    sets = postings.groupBy("_entry").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("token")).alias("_one"), F.bit_xor(F.xxhash64("token", F.lit(1))).alias("_two")
    )
    firsts = sets.groupBy("size", "_one", "_two").agg(F.min("_entry").alias("_entry")).select("_entry", "size")
    return postings.join(firsts, "_entry").select("token", "_entry", "size")


def _token_facts(postings: DataFrame) -> DataFrame:
    """Per token: how many entries hold it, the tokens of the largest of them, and the first of them."""
    return postings.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.max("size").alias("largest"), F.min("_entry").alias("first")
    )


def _by_rarity(held: DataFrame, facts: DataFrame) -> DataFrame:
    """(_set, tokens) from (_set, token): the known tokens of each set with their facts, rarest first."""
    return (
        held.join(facts, "token").groupBy("_set")
        .agg(F.array_sort(F.collect_list(F.struct("n", "token", "largest", "first"))).alias("tokens"))
    )


def _best_by_counts(sets: DataFrame, pairs: DataFrame, entries: list[int]) -> DataFrame:
    """`_set`, `_entry` with the best score, from (token, _entry), for `entries` that are few, in order.

    A token marks its entries by the bits of a few numbers, 64 entries each. One row per token of a set meets its marks,
    and what is gathered per set are these numbers, not its entries: it grows with the texts alone.
    """
    numbered = written_table(sets.withColumn("_number", F.monotonically_increasing_id()), "texts")
    listed = F.lit(entries).cast("array<bigint>")
    place = (F.array_position(listed, F.col("_entry")) - 1).cast("int")
    words = {f"w{k}": range(first, min(first + 64, len(entries))) for k, first in enumerate(range(0, len(entries), 64))}
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("_place", F.lit(64)))
    marks = [F.bit_or(F.when(F.col("_place").between(own[0], own[-1]), bit).otherwise(F.lit(0).cast("bigint"))).alias(name) for name, own in words.items()]
    marked = written_table(pairs.withColumn("_place", place).groupBy("token").agg(*marks), "marks")
    met = (
        numbered.select("_number", F.explode("_tokens").alias("token")).join(marked, "token")
        .groupBy("_number").agg(*[F.collect_list(name).alias(name) for name in words])
    )

    def scores(name: str, own: range) -> Column:
        def score(i: Column) -> Column:
            shared = F.size(F.filter(name, lambda marks: F.getbit(marks, i) == 1))
            return F.struct((-shared).alias("score"), (i + own[0]).alias("place"))

        return F.transform(F.sequence(F.lit(0), F.lit(len(own) - 1)), score)

    best = F.array_min(F.concat(*[scores(name, own) for name, own in words.items()]))
    found = met.select("_number", F.get(listed, best["place"]).alias("_entry"))
    return numbered.select("_number", "_set").join(found, "_number").select("_set", "_entry")


def _best_by_threshold(sets: DataFrame, dictionary: DataFrame, hot_entries: int, few_entries: int) -> DataFrame:
    """`_set`, `_found` of the token sets (_set, _tokens) that share a token with some entry.

    A few entries are counted (`_best_by_counts`).

    Entries are numbered in the order of (key, value) and stay long, one row per token. Entries with a rare token of a set
    are searched from its rarest token on (`_search`). Entries that share only hot tokens with it differ for it in which
    of those they hold, so they are searched once per distinct set of hot tokens, among the distinct sets of hot tokens
    that entries have. The better of both answers counts: what the second search finds is an entry whose score is no
    less than what it was found with.
    """
    # Joins with the tables written here are planned by the size of their files.
    numbers = dictionary.select("key", "value").distinct().orderBy("key", "value")
    numbers = written_table(numbers.withColumn("_entry", F.monotonically_increasing_id()), "entries")
    named = numbers.select(F.col("key").alias("_key"), F.col("value").alias("_value"), "_entry")
    same = F.col("key").eqNullSafe(F.col("_key")) & F.col("value").eqNullSafe(F.col("_value"))
    pairs = _postings(dictionary).join(named, same).select("token", "_entry").distinct()
    few = rows_if_small(numbers.select("_entry"), few_entries)
    if few is not None:
        return _best_by_counts(sets, pairs, sorted(row["_entry"] for row in few)).join(numbers, "_entry").select("_set", F.col("value").alias("_found"))
    postings = written_table(_unlike(pairs), "postings")
    held = sets.select("_set", F.explode("_tokens").alias("token"))
    is_hot = lambda token: token["n"] > hot_entries
    known = written_table(
        _by_rarity(held, _token_facts(postings)).select(
            "_set", F.filter("tokens", lambda t: ~is_hot(t)).alias("tokens"),
            F.transform(F.filter("tokens", is_hot), lambda t: t["token"]).alias("others"),
        ), "sets",
    )
    best = _search(known.where(F.size("tokens") > 0), postings)
    hot_sets = known.where(F.size("others") > 0).select(
        "_set", F.md5(F.array_join(F.array_sort("others"), " ").cast("binary")).alias("_hot"), "others"
    )
    if not hot_sets.isEmpty():
        hot_tokens = _token_facts(postings).where(F.col("n") > hot_entries).select("token")
        projected = written_table(_unlike(postings.join(hot_tokens, "token", "left_semi").select("token", "_entry")), "hot-postings")
        hot_held = hot_sets.dropDuplicates(["_hot"]).select(F.col("_hot").alias("_set"), F.explode("others").alias("token"))
        hot_known = _by_rarity(hot_held, _token_facts(projected)).withColumn("others", F.array().cast("array<string>"))
        hot_best = _search(written_table(hot_known, "hot-sets"), projected).withColumnRenamed("_set", "_hot")
        best = best.unionByName(hot_sets.join(hot_best, "_hot").select("_set", "_score", "_entry"))
    first = best.groupBy("_set").agg(F.min(F.struct((-F.col("_score")).alias("score"), "_entry"))["_entry"].alias("_entry"))
    return first.join(numbers, "_entry").select("_set", F.col("value").alias("_found"))


def _hits(asked: DataFrame, postings: DataFrame) -> DataFrame:
    """Every entry of the asked tokens (_set, token): one row per (set, token, entry)."""
    return asked.join(postings, "token").select("_set", "_entry", "size")


def _search(sets: DataFrame, postings: DataFrame) -> DataFrame:
    """`_set`, `_score`, `_entry`: the entry that shares most tokens with a set, of those that hold one of its `tokens`.

    Sets have their `tokens`, rarest first, and `others`, which count but are not searched by. Each round takes the entries
    of the next tokens of a set and counts what they share so far; what is left of the set bounds what they, and entries
    not met so far, can still reach. Entries below the best count are left out. A set is closed as soon as no entry that
    was not met can win any more, and the entries that are left then are compared exactly, by looking up the rest of the
    set in them: tokens with long lists are mostly never listed. Equal scores go to the first entry, by the same bounds.
    """
    open_, taken, block, counts = sets, 0, FIRST_TOKENS, None
    closed, kept = [], []
    while True:
        rest = F.slice("tokens", taken + 1, 2**31 - 1 - taken)
        left = F.size("rest") + F.size("others")
        unmet = F.when(F.size("rest") > 0, F.least(left, F.array_max(F.transform("rest", lambda t: t["largest"])))).otherwise(0)
        first = F.array_min(F.transform("rest", lambda t: t["first"]))
        rows = open_.withColumn("rest", rest)
        if counts is None:
            rows = rows.withColumns({"floor": F.lit(0).cast("bigint"), "leader": F.lit(None).cast("bigint")})
        else:
            best = counts.groupBy("_set").agg(F.min(F.struct((-F.col("met")).alias("met"), "_entry")).alias("_best"))
            floor = F.coalesce(-F.col("_best.met"), F.lit(0).cast("bigint"))
            rows = rows.join(best, "_set", "left").withColumns({"floor": floor, "leader": F.col("_best._entry")}).drop("_best")
        # With one token to share, the first entry of the lists is the best that was not met.
        done = (unmet <= 1) | (unmet < F.col("floor")) | ((unmet == F.col("floor")) & (first > F.col("leader")))
        judged = written_table(
            rows.select("_set", "tokens", "others", "rest", left.alias("left"), "floor", "leader",
                        F.coalesce(done, F.lit(False)).alias("done"), F.when(unmet == 1, first).alias("first")), "judged",
        )
        closed.append(judged.where("done"))
        open_ = judged.where(~F.col("done")).select("_set", "tokens", "others")
        more = not open_.isEmpty()
        alive = None
        if counts is not None:
            reach = F.least(F.col("size"), F.col("met") + F.col("left"))
            wins = (F.col("_entry") == F.col("leader")) | (reach > F.col("floor")) | ((reach == F.col("floor")) & (F.col("_entry") < F.col("leader")))
            alive = written_table(
                counts.join(judged.select("_set", "left", "floor", "leader", "done"), "_set").where(wins).select("_set", "_entry", "size", "met", "done"), "alive"
            )
            kept.append(alive.where("done").drop("size", "done"))
        if not more:
            break
        asked = open_.select("_set", F.explode(F.transform(F.slice("tokens", taken + 1, block), lambda t: t["token"])).alias("token"))
        met = _hits(asked, postings).withColumn("met", F.lit(1).cast("bigint"))
        if alive is not None:
            met = met.unionByName(alive.where(~F.col("done")).drop("done"))
        counts = written_table(met.groupBy("_set", "_entry").agg(F.max("size").alias("size"), F.sum("met").alias("met")), "counts")
        taken, block = taken + block, block * MORE_TOKENS
    ends = reduce(DataFrame.unionByName, closed)
    scored = ends.where(F.col("first").isNotNull()).select("_set", F.col("first").alias("_entry"), F.lit(1).cast("bigint").alias("_score"))
    if kept:
        found = reduce(DataFrame.unionByName, kept)
        rest_of = ends.select("_set", F.concat(F.transform("rest", lambda t: t["token"]), "others").alias("more"))
        probed = found.join(rest_of, "_set").select("_set", "_entry", F.explode("more").alias("token"))
        shared = probed.join(postings.select("token", "_entry"), ["token", "_entry"], "left_semi").groupBy("_set", "_entry").agg(F.count(F.lit(1)).alias("more"))
        exact = found.join(shared, ["_set", "_entry"], "left").select("_set", "_entry", (F.col("met") + F.coalesce("more", F.lit(0))).alias("_score"))
        scored = scored.unionByName(exact)
    return (
        scored.groupBy("_set")
        .agg(F.min(F.struct((-F.col("_score")).alias("score"), "_entry")).alias("_best"))
        .select("_set", (-F.col("_best.score")).alias("_score"), F.col("_best._entry").alias("_entry"))
    )
