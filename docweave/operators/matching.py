"""Which documents answer an export request: channel, date range and the keyword rules of a dataset.

Each request is reduced to *targets* (request, dataset) that carry their channels, dates and rules, and every target is
reachable by a few *entry keys*: one word of each of its rules, or, without rules, the months or years that it covers,
each with its channels. A document finds its targets by an equi-join on the entry keys it holds.

With few entry keys a document is read once and never shuffled: the full condition is tested on its row. With many, a
count-min sketch of all document words first tells which word of each rule the fewest documents hold; candidates are
then found on narrow rows, and a document's texts are fetched for those rules alone that it is a candidate of.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from docweave.bounds import PLAN_ROWS, broadcast_if_small, rows_if_small
from docweave.functions import text as T
from docweave.functions.dictionary import let
from docweave.scratch import written_table
from docweave.sources.tables import STORED_COLUMNS

# Bounds that stand for a missing date.
FIRST_MOMENT, LAST_MOMENT = "1900-01-01 00:00:00", "2100-12-31 23:59:59"

# Datasets with more rules keep one row per rule instead of carrying all of them on each row.
RULES_IN_ROW = 64

# First channel numbers that a scan is pruned by, at most.
CHANNELS_IN_PLAN = 256

# Lines and cells per line of the sketch of document words.
SKETCH_LINES, SKETCH_CELLS = 4, 1 << 16

# Targets without rules are entered by month up to so many months, else by year.
MONTHS = 36

RULE = (
    "struct<required:array<string>,title:array<string>,content:array<string>,url:array<string>>"
)


# -- channel ---------------------------------------------------------------------------------------------

def channel_pairs(channel: Column) -> Column:
    """Pairs (depth1_seq, depth2_seq) of `d1^d2,d2;d1^d2`; null when every channel is meant."""
    entries = F.filter(F.split(channel, ";", -1), lambda entry: F.trim(entry) != "")

    def pairs(entry: Column) -> Column:
        depth1 = F.trim(F.split_part(entry, F.lit("^"), F.lit(1))).try_cast("int")
        return F.transform(
            F.split(F.split_part(entry, F.lit("^"), F.lit(2)), ",", -1),
            lambda depth2: F.struct(depth1.alias("depth1_seq"), F.trim(depth2).try_cast("int").alias("depth2_seq")),
        )

    every = channel.isNull() | F.trim(channel).isin("", "all")
    return F.when(~every, F.array_distinct(F.flatten(F.transform(entries, pairs))))


def in_channels(docs: DataFrame, channel: str | None) -> DataFrame:
    """Documents of the given channels."""
    if channel is None or channel.strip() in ("", "all"):
        return docs
    pairs = docs.sparkSession.range(1).select(F.inline(channel_pairs(F.lit(channel))))
    return docs.join(broadcast_if_small(pairs), ["depth1_seq", "depth2_seq"], "left_semi")


# -- date range ------------------------------------------------------------------------------------------

def bound(date: Column, missing: str) -> Column:
    return F.coalesce(F.nullif(date, F.lit("")), F.lit(missing)).cast("timestamp_ntz")


def in_period(docs: DataFrame, start_date: str | None, end_date: str | None) -> DataFrame:
    """Documents of the inclusive period; an empty bound is open."""
    start = F.lit(start_date or FIRST_MOMENT).cast("timestamp_ntz")
    end = F.lit(end_date or LAST_MOMENT).cast("timestamp_ntz")
    return docs.where(F.col("doc_datetime").between(start, end))


# -- keyword rules ---------------------------------------------------------------------------------------

def _phrases(listed: Column) -> Column:
    """Comma list as padded phrases, empty ones dropped."""
    phrases = F.transform(F.split(F.coalesce(listed, F.lit("")), ",", -1), T.padded)
    return F.array_distinct(F.filter(phrases, lambda phrase: F.trim(phrase) != ""))


def _urls(listed: Column) -> Column:
    urls = F.transform(F.split(F.coalesce(listed, F.lit("")), ",", -1), lambda url: F.lower(F.trim(url)))
    return F.array_distinct(F.filter(urls, lambda url: url != ""))


def _entry_word(required: Column) -> Column:
    """The longest word of the required phrases, as a guess at the one that fewest documents hold."""
    return F.array_min(F.transform(_words_of(required), lambda w: F.struct((-F.char_length(w)).alias("n"), w.alias("w"))))["w"]


def _words_of(required: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(required, T.padded_tokens)))


def word_sketch(held: DataFrame) -> DataFrame:
    """(line, cell, n): a count-min sketch of how many rows of `held` (keys) hold each key.

    It has a fixed size, however many documents and words there are, and is summed up before it is shuffled.
    """
    cell = lambda i: F.struct(F.lit(i).alias("line"), F.pmod(F.xxhash64("key", F.lit(i)), F.lit(SKETCH_CELLS)).alias("cell"))
    keys = held.select(F.explode("keys").alias("key"))
    return keys.select(F.inline(F.array(*map(cell, range(SKETCH_LINES))))).groupBy("line", "cell").agg(F.count(F.lit(1)).alias("n"))


def sketched_counts(words: DataFrame, sketch: DataFrame) -> DataFrame:
    """(word, n) of distinct words: a count that is never too small, as several words may share a cell."""
    cells = [F.struct(F.lit(i).alias("line"), F.pmod(F.xxhash64("word", F.lit(i)), F.lit(SKETCH_CELLS)).alias("cell")) for i in range(SKETCH_LINES)]
    placed = words.select("word", F.inline(F.array(*cells)))
    found = placed.join(sketch, ["line", "cell"], "left")
    return found.groupBy("word").agg(F.min(F.coalesce("n", F.lit(0))).alias("n"))


def entered_by_rarest(active: DataFrame, sketch: DataFrame) -> DataFrame:
    """Active rules whose `entry_word` is the required word that fewest documents hold by the sketch, the longest on a tie."""
    numbered = written_table(active.withColumn("_rule", F.monotonically_increasing_id()), "rules")
    words = numbered.select("_rule", F.explode(_words_of(F.col("rule.required"))).alias("word"))
    counted = sketched_counts(words.select("word").distinct(), sketch)
    rarest = words.join(counted, "word").groupBy("_rule").agg(
        F.min(F.struct("n", (-F.char_length("word")).alias("l"), "word"))["word"].alias("entry_word")
    )
    return numbered.drop("entry_word").join(rarest, "_rule").drop("_rule")


def active_rules(rules: DataFrame) -> DataFrame:
    """Rules in use, one row per rule: `dataset_seq`, `entry_word` and the parsed `rule`.

    A rule without any required word matches nothing and is left out. The entry word is the longest required one; where
    there are many, `entered_by_rarest` measures instead.
    """
    required = F.array_union(_phrases(F.col("keyword")), _phrases(F.col("sub_keywords")))
    rule = F.struct(
        required.alias("required"),
        _phrases(F.col("title_filter_keywords")).alias("title"),
        _phrases(F.col("content_filter_keywords")).alias("content"),
        _urls(F.col("filter_urls")).alias("url"),
    )
    return (
        rules.where((F.col("use_yn") == "Y") & (F.size(required) > 0))
        .select("dataset_seq", rule.alias("rule"))
        .withColumn("entry_word", _entry_word(F.col("rule.required")))
    )


def holds_required(rule: Column, title: Column, content: Column) -> Column:
    """Every required phrase is in the title or in the content."""
    return F.forall(rule["required"], lambda p: T.holds_phrase(title, p) | T.holds_phrase(content, p))


def is_excluded(rule: Column, title: Column, content: Column, url: Column) -> Column:
    return (
        F.exists(rule["title"], lambda p: T.holds_phrase(title, p))
        | F.exists(rule["content"], lambda p: T.holds_phrase(content, p))
        | F.exists(rule["url"], lambda u: F.contains(url, u))
    )


def _month(moment: Column | str) -> Column:
    return 12 * F.year(moment) + F.month(moment)


def _period_key(kind: str, number: Column, *channel: Column) -> Column:
    """`#m` and the number of a month, or `#y` and a year, with a channel if one is given; a missing part of it is empty."""
    parts = [F.lit(f"#{kind}"), number.cast("string")]
    for depth in channel:
        parts += [F.lit("^"), F.coalesce(depth.cast("string"), F.lit(""))]
    return F.concat(*parts)


def _period_keys() -> Column:
    """The period keys a document can be entered by."""
    moment, channel = F.col("doc_datetime"), [F.col("depth1_seq").cast("int"), F.col("depth2_seq").cast("int")]
    periods = [("m", _month(moment)), ("y", F.year(moment))]
    keys = F.array(*[_period_key(kind, number, *own) for kind, number in periods for own in ([], channel)])
    return F.filter(keys, lambda key: key.isNotNull())


def _open_keys() -> Column:
    """The period keys of a target without rules: its months, or its years if they are many, with each of its channels."""

    def of_period(kind: str, first: Column, last: Column) -> Column:
        def of_channels(number: Column) -> Column:
            return F.transform("channels", lambda pair: _period_key(kind, number, pair["depth1_seq"], pair["depth2_seq"]))

        numbers = F.sequence(first, last)
        every = F.transform(numbers, lambda number: _period_key(kind, number))
        return F.when(F.col("channels").isNull(), every).otherwise(F.flatten(F.transform(numbers, of_channels)))

    by_month = of_period("m", _month("start"), _month("end"))
    return F.when(_month("end") - _month("start") < MONTHS, by_month).otherwise(of_period("y", F.year("start"), F.year("end")))


def _rules_per_entry_word(active: DataFrame, rules_in_row: int, own_only: bool = False) -> DataFrame:
    """`dataset_seq`, `entry_key`, the `rules` to test there, and all `entry_words` that have the same rules.

    These are all rules of a dataset, or with `own_only` those alone that are entered by that word: no other rule can take
    a document for it, but a pair may then be found at several words. Where there are more than `rules_in_row` rules, there is
    one row per rule, and its `entry_words` are left empty.
    """
    together = ["dataset_seq", "entry_word"] if own_only else ["dataset_seq"]
    sizes = active.groupBy(*together).agg(F.count(F.lit(1)).alias("_n"))
    sized = active.join(broadcast_if_small(sizes), together)
    whole = (
        sized.where(F.col("_n") <= rules_in_row)
        .groupBy(*together)
        .agg(
            F.array_sort(F.collect_list("rule")).alias("rules"),
            F.array_sort(F.collect_set("entry_word")).alias("entry_words"),
        )
        .select("dataset_seq", F.explode_outer("entry_words").alias("entry_key"), "rules", "entry_words")
    )
    single = sized.where(F.col("_n") > rules_in_row).select(
        "dataset_seq", F.col("entry_word").alias("entry_key"), F.array("rule").alias("rules"),
        F.array().cast("array<string>").alias("entry_words"),
    )
    return whole.unionByName(single)


def targets(requests: DataFrame, active: DataFrame | None, rules_in_row: int = RULES_IN_ROW, own_only: bool = False) -> DataFrame:
    """Requests as targets: `seq`, `dataset_seq`, `channels`, `start`, `end`, `rules`, `entry_words`, `entry_key`.

    Input has one row per (request, dataset), as `requests.with_datasets` gives, and the `active_rules`. A dataset
    without active rules gives no target, so it matches nothing.
    """
    base = requests.select(
        "seq", "dataset_seq",
        channel_pairs(F.col("channel")).alias("channels"),
        bound(F.col("start_date"), FIRST_MOMENT).alias("start"),
        bound(F.col("end_date"), LAST_MOMENT).alias("end"),
    ).distinct()
    open_targets = base.where(F.col("dataset_seq").isNull() & (F.col("start") <= F.col("end"))).select(
        "*",
        F.array().cast(f"array<{RULE}>").alias("rules"),
        F.array().cast("array<string>").alias("entry_words"),
        F.explode(_open_keys()).alias("entry_key"),
    )
    if active is None:
        return open_targets
    entries = _rules_per_entry_word(active, rules_in_row, own_only)
    return open_targets.unionByName(base.join(broadcast_if_small(entries), "dataset_seq"))


_TEXTS = ["_title", "_content", "_url", "_keys"]


def _with_texts(docs: DataFrame) -> DataFrame:
    """Add the normalised texts, and the entry keys a document can have: its words and its year."""
    title, content = T.padded(F.col("doc_title")), T.padded(F.col("doc_content"))
    return docs.select(
        "*", title.alias("_title"), content.alias("_content"),
        F.lower(F.coalesce("doc_url", F.lit(""))).alias("_url"),
    )


def _entry_keys() -> Column:
    words = F.split(F.btrim(F.concat("_title", "_content")), " +", -1)
    return F.concat(words, _period_keys())


def _accepted() -> Column:
    """Whether the target of a joined row takes the document, counting each pair at its first entry key only."""
    title, content, url = F.col("_title"), F.col("_content"), F.col("_url")
    first_key = F.get(F.filter("entry_words", lambda word: F.array_contains("_keys", word)), F.lit(0))
    return (
        _asked()
        & ((F.size("entry_words") == 0) | (first_key == F.col("entry_key")))
        & ((F.size("rules") == 0) | _by_rule(title, content, url))
    )


def _asked() -> Column:
    """Whether a document is in the period and the channels of a target."""
    pair = F.struct(F.col("depth1_seq").cast("int").alias("depth1_seq"), F.col("depth2_seq").cast("int").alias("depth2_seq"))
    return F.col("doc_datetime").between(F.col("start"), F.col("end")) & (
        F.col("channels").isNull() | F.array_contains(F.coalesce("channels", F.array(pair)), pair)
    )


def _by_rule(title: Column, content: Column, url: Column) -> Column:
    """Whether one of the `rules` takes the texts."""
    return F.exists("rules", lambda rule: holds_required(rule, title, content) & ~is_excluded(rule, title, content, url))


def filter_documents(
    docs: DataFrame,
    requests: DataFrame,
    rules: DataFrame | None = None,
    max_in_plan: int = PLAN_ROWS,
    rules_in_row: int = RULES_IN_ROW,
) -> DataFrame:
    """Every (request, dataset, document) for which the document answers the request.

    `requests` has one row per (request, dataset). The columns of `docs` are kept, after `seq` and
    `dataset_seq`. Each row of `docs` counts for itself, also where ids are null or repeated.
    """
    # Small, and read several times: for its bounds, its keys, its size and by the join.
    active = None if rules is None else active_rules(rules)
    wanted = written_table(targets(requests, active, rules_in_row), "targets")
    keys = rows_if_small(wanted.select("entry_key").distinct(), max_in_plan)
    # Only where a dataset has one row per rule can a pair be found twice.
    once = wanted.where((F.size("entry_words") == 0) & (F.size("rules") > 0)).isEmpty()
    if not once or keys is None:
        measured = lambda sketch: targets(requests, None if active is None else entered_by_rarest(active, sketch), rules_in_row, own_only=True)
        return _filter_by_number(_pruned(docs, wanted), measured, docs.columns)
    texts = _with_texts(_pruned(docs, wanted))
    # Only keys that some target asks for leave the row, so few copies of a document are made.
    asked = [row.entry_key for row in keys]
    held = F.array_distinct(F.filter(_entry_keys(), lambda key: key.isin(asked)))
    # Exploding an expression instead of a column keeps Spark from testing its size ahead, at double cost.
    with_all = let(
        held, lambda keys: F.transform(keys, lambda key: F.struct(key.alias("entry_key"), keys.alias("_keys")))
    )
    pairs = (
        texts.select("*", F.explode(with_all).alias("_held"))
        .select(*texts.columns, "_held.*")
        .join(broadcast_if_small(wanted), "entry_key")
    )
    return pairs.where(_accepted()).select("seq", "dataset_seq", *docs.columns)


def _pruned(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Documents in the period of all targets together, and in their channels if none asks for every channel.

    The bounds are a few values, so they are plain conditions that reach the scan of stored documents, and choose the
    folders of those that are stored by month and channel.
    """
    span = wanted.agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count_if(F.col("channels").isNull()).alias("n_every")).first()
    if span.start is None:
        return docs.where(F.lit(False))
    docs = docs.where(F.col("doc_datetime").between(F.lit(span.start), F.lit(span.end)))
    stored = set(STORED_COLUMNS) <= set(docs.columns)
    if stored:
        # Only folders of months that some target covers are listed and read.
        months = rows_if_small(wanted.select(F.explode(F.sequence(_month("start"), _month("end"))).alias("month")).distinct(), PLAN_ROWS)
        docs = docs if months is None else docs.where(F.col("stored_month").isin([row.month for row in months]))
    if span.n_every:
        return docs
    firsts = rows_if_small(wanted.select(F.explode("channels.depth1_seq").alias("depth1_seq")).distinct(), CHANNELS_IN_PLAN)
    if firsts is None or any(row.depth1_seq is None for row in firsts):
        return docs
    listed = [row.depth1_seq for row in firsts]
    docs = docs.where(F.col("depth1_seq").isin(listed))
    return docs.where(F.col("stored_channel").isin(listed)) if stored else docs


def _filter_by_number(docs: DataFrame, targets_by: Callable[[DataFrame], DataFrame], columns: list[str]) -> DataFrame:
    """The same pairs for many entry keys, or for datasets with one row per rule.

    Documents get a number that is written once, because their ids may be null or repeated. Words are counted and
    candidates (document, target) found on narrow rows. A target is a request with the rules of one entry word, so a text
    is held against those rules alone whose rarest word it has. Requests for one dataset share its rules, so a document's texts
    meet each set of rules once, whoever asks; a pair that several rules accept counts once.
    """
    numbered = written_table(docs.select("*", F.monotonically_increasing_id().alias("_number")), "documents")
    place = ["_number", "doc_datetime", "depth1_seq", "depth2_seq"]
    held = written_table(_with_texts(numbered).select(*place, F.array_distinct(_entry_keys()).alias("keys")), "keys")
    wanted = targets_by(written_table(word_sketch(held), "sketch"))
    wanted = written_table(wanted.withColumn("_digest", F.when(F.size("rules") > 0, F.md5(F.to_json("rules").cast("binary")))), "targets")
    # Pairs carry a number of their rules, which takes little room in a shuffle.
    sets = wanted.where(F.col("_digest").isNotNull()).select("_digest", "rules").dropDuplicates(["_digest"])
    sets = written_table(sets.withColumn("_rules", F.monotonically_increasing_id()), "rule-sets")
    wanted = wanted.join(broadcast_if_small(sets.select("_digest", "_rules")), "_digest", "left")
    asking = wanted.select("seq", "dataset_seq", "channels", "start", "end", "_rules", "entry_key")
    met = held.select(*place, F.explode("keys").alias("entry_key"))
    candidates = met.join(broadcast_if_small(asking), "entry_key").where(_asked()).select("_number", "seq", "dataset_seq", "_rules").distinct()
    candidates = written_table(candidates, "candidates")
    tested = candidates.where(F.col("_rules").isNotNull()).select("_number", "_rules").distinct()
    rules = sets.select("_rules", "rules")
    texts = _with_texts(numbered.join(tested.select("_number").distinct(), "_number", "left_semi")).select("_number", "_title", "_content", "_url")
    accepted = (
        tested.join(texts, "_number").join(broadcast_if_small(rules), "_rules")
        .where(_by_rule(F.col("_title"), F.col("_content"), F.col("_url")))
        .select("_number", "_rules")
    )
    by_rules = candidates.join(accepted, ["_number", "_rules"]).select("seq", "dataset_seq", "_number")
    found = by_rules.unionByName(candidates.where(F.col("_rules").isNull()).select("seq", "dataset_seq", "_number")).distinct()
    return numbered.join(found, "_number").select("seq", "dataset_seq", *columns)


def match_datasets(
    docs: DataFrame, rules: DataFrame, max_in_plan: int = PLAN_ROWS, rules_in_row: int = RULES_IN_ROW
) -> DataFrame:
    """Every (dataset, document) for which at least one rule of the dataset accepts the document."""
    requests = rules.select(
        F.lit(0).alias("seq"), "dataset_seq", F.lit("all").alias("channel"), F.lit("").alias("start_date"),
        F.lit("").alias("end_date"),
    ).distinct()
    return filter_documents(docs, requests, rules, max_in_plan, rules_in_row).drop("seq")


def rule_decisions(docs: DataFrame, rules: DataFrame, keep: list[str], max_in_plan: int = PLAN_ROWS) -> DataFrame:
    """Every (document, rule) whose required phrases are all there, with the exclusions that apply.

    `rules` has a `rule_id` and the columns of the rule table. With many entry words, documents get a number and meet
    their rules on narrow rows; the texts are joined to those pairs.
    """
    parsed = active_rules(rules.withColumn("dataset_seq", F.struct("dataset_seq", "rule_id")))
    words = rows_if_small(parsed.select("entry_word").distinct(), max_in_plan)
    if words is not None:
        asked = [row.entry_word for row in words]
        held = F.array_distinct(F.filter(_entry_keys(), lambda key: key.isin(asked)))
        entries = parsed.select("dataset_seq.*", "rule", F.col("entry_word").alias("entry_key"))
        pairs = _with_texts(docs).withColumn("entry_key", F.explode(held)).join(broadcast_if_small(entries), "entry_key")
    else:
        numbered = written_table(docs.select("*", F.monotonically_increasing_id().alias("_number")), "documents")
        keys = written_table(_with_texts(numbered).select("_number", F.array_distinct(_entry_keys()).alias("keys")), "keys")
        entered = entered_by_rarest(parsed, written_table(word_sketch(keys), "sketch"))
        entries = entered.select("dataset_seq.*", "rule", F.col("entry_word").alias("entry_key"))
        met = keys.select("_number", F.explode("keys").alias("entry_key")).join(broadcast_if_small(entries), "entry_key")
        pairs = _with_texts(numbered).join(met, "_number")
    title, content, url, rule = F.col("_title"), F.col("_content"), F.col("_url"), F.col("rule")
    return pairs.where(holds_required(rule, title, content)).select(
        *keep, "dataset_seq", "rule_id",
        F.exists(rule["title"], lambda p: T.holds_phrase(title, p)).alias("title_excluded"),
        F.exists(rule["content"], lambda p: T.holds_phrase(content, p)).alias("content_excluded"),
        F.exists(rule["url"], lambda u: F.contains(url, u)).alias("url_excluded"),
    )
