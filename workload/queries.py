"""Every operator as a query over whole provided tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.functions import hangul, tags, text as T, topics
from docweave.functions.tags import KOREAN_AND_LATIN as LETTERS
from docweave.operators import clauses, lookup, matching, paging, payload, related, requests, spans, tagging
from docweave.plans import export, ingest, jobs
from docweave.scratch import fresh_path, written_table
from docweave.session import allow_legacy_charsets, session_for_repeated_texts
from docweave.sinks import files as sinks
from docweave.sources import files as sources, tables
from workload import tables as W

Query = Callable[[SparkSession, str], DataFrame]
PAGE_SIZE = 100
CHANNEL = "1^1,2,3;2^4,5;3^7,11"
FROM_DATE = "2024-03-01 00:00:00"


def _big(df: DataFrame, *names: str) -> DataFrame:
    """Counts and ordinals as BIGINT, to compare alike across engines."""
    return df.withColumns({name: F.col(name).cast("bigint") for name in names})


def _stamp(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


# -- export ----------------------------------------------------------------------------------------------

def channel_filter(spark, sf):
    found = matching.in_channels(W.crawl_doc(spark, sf, with_url=False), CHANNEL)
    return _big(found.select("doc_id", "depth1_seq", "depth2_seq"), "depth1_seq", "depth2_seq")


def date_range_filter(spark, sf):
    found = matching.in_period(W.crawl_doc(spark, sf, with_url=False), FROM_DATE, "")
    return found.select("doc_id", _stamp("doc_datetime"))


def dataset_match(spark, sf):
    found = matching.match_datasets(W.crawl_doc(spark, sf), W.small(spark, W.RULES))
    return _big(found.select("dataset_seq", "doc_id"), "dataset_seq")


def _decisions(spark, sf, *flags):
    decided = matching.rule_decisions(W.crawl_doc(spark, sf), W.small(spark, W.RULES), ["doc_id"])
    return _big(decided.select("doc_id", "rule_id", *flags), "rule_id", *flags)


def dataset_exclusion(spark, sf):
    return _decisions(spark, sf, "title_excluded", "content_excluded")


def url_exclusion(spark, sf):
    return _decisions(spark, sf, "url_excluded")


def filter_documents(spark, sf):
    found = export.matched_documents(W.crawl_doc(spark, sf), W.control_tables(spark))
    shown = found.select("seq", "dataset_seq", "doc_id", _stamp("doc_datetime"), "doc_title", "depth1_seq", "depth2_seq")
    return _big(shown, "seq", "dataset_seq", "depth1_seq", "depth2_seq")


def filter_documents_stored(spark, sf):
    """`filter_documents` over documents that are stored by month and channel."""
    path = fresh_path(spark, "documents")
    tables.write_documents(W.crawl_doc(spark, sf), path)
    found = export.matched_documents(tables.read_documents(spark, path), W.control_tables(spark))
    shown = found.select("seq", "dataset_seq", "doc_id", _stamp("doc_datetime"), "doc_title", "depth1_seq", "depth2_seq")
    return _big(shown, "seq", "dataset_seq", "depth1_seq", "depth2_seq")


def pending_requests(spark, sf):
    found = requests.pending_requests(W.order_queue(spark, sf), W.customer_users(spark, sf))
    return _big(found, "seq", "user_seq", "account_seq", "campaign_seq")


def request_type_names(spark, sf):
    found = requests.with_type_names(W.order_queue(spark, sf), W.small(spark, W.CODES))
    return _big(found.select("seq", "type_cd", "type_name"), "seq")


def request_datasets(spark, sf):
    """Requests with the active rules of their datasets."""
    wanted = requests.with_datasets(W.order_queue(spark, sf))
    found = requests.with_rules(wanted, W.small(spark, W.RULES))
    return _big(found.select("seq", "dataset_seq", "rule_id"), "seq", "dataset_seq", "rule_id")


def export_pages(spark, sf):
    # Written first, because the range sort reads its input twice.
    matched = written_table(export.matched_documents(W.crawl_doc(spark, sf), W.control_tables(spark)), "matched")
    paged = paging.add_pages(matched, PAGE_SIZE)
    ints = [name for name in paged.columns if name.endswith("_seq")]
    return _big(paged.withColumn("doc_datetime", _stamp("doc_datetime")), "seq", *ints)


def export_manifest(spark, sf):
    control = W.control_tables(spark)
    matched = export.matched_documents(W.crawl_doc(spark, sf), control)
    return _big(paging.manifest(export.named_requests(control), matched, PAGE_SIZE), "seq", "dataset_seq", "total", "page")


def exported_files(spark, sf):
    """The whole job: requests taken up, pages and manifest written and committed, and what is live read back."""
    base, log = fresh_path(spark, "export"), fresh_path(spark, "status-log")
    control = W.control_tables(spark)
    # The queue's own request in progress (P) is left to the run that holds it.
    control.queue = control.queue.where("status <> 'P'")
    export.run_export(W.crawl_doc(spark, sf), control, base, log, PAGE_SIZE)
    found = export.live_pages(spark, base, log)
    return found.select(F.col("seq").cast("bigint").alias("seq"), "file_name", "doc_id", "doc_title", F.col("view_count").cast("bigint").alias("view_count"))


def request_status(spark, sf):
    return requests.current_status(W.status_log(spark, sf))


# -- text ------------------------------------------------------------------------------------------------

def sentences(spark, sf):
    return _big(clauses.split_sentences(W.plain_docs(spark, sf), ["doc_id"], "content"), "sentence_idx")


def sentences_multi(spark, sf):
    found = clauses.split_sentences(W.survey(spark, sf), jobs.SURVEY_KEYS, "comment", tags.SENTENCE_END_MULTI)
    return _big(found, "sentence_idx")


def clean_text(spark, sf):
    docs, content = W.plain_docs(spark, sf), F.col("content")
    return docs.select(
        "doc_id", T.blank_punctuation(content).alias("blanked"), T.tagger_input(content, LETTERS).alias("kept")
    )


def _sentences(spark, sf):
    return clauses.split_sentences(W.plain_docs(spark, sf), ["doc_id"], "content")


def _tagged(spark, sf):
    keys = ["doc_id", "sentence_idx"]
    return tagging.tag_sentences(_sentences(spark, sf), W.small(spark, W.LEXICON), keys, letters=LETTERS)


def tag_tokens(spark, sf):
    return _big(_tagged(spark, sf).select("doc_id", "sentence_idx", "sentence_kma"), "sentence_idx")


def strip_tags(spark, sf):
    plain = T.strip_tags(F.col("sentence_kma"))
    return _big(_tagged(spark, sf).select("doc_id", "sentence_idx", plain.alias("plain")), "sentence_idx")


def clause_rows(spark, sf):
    found = clauses.split_clauses(_tagged(spark, sf)).drop("sentence")
    return _big(found, "sentence_idx", "clause_idx")


def _parsed_clauses(spark, sf):
    return clauses.add_subjects_and_verb(clauses.split_clauses(_tagged(spark, sf)))


def _exploded(rows):
    """One row per subject. The outer form keeps Spark from testing the array's size ahead, at double cost."""
    found = rows.select(
        "doc_id", "sentence_idx", "clause_idx", F.posexplode_outer("subjects").alias("attr_idx", "subject")
    )
    return found.where(F.col("attr_idx").isNotNull())


def conjunct_subjects(spark, sf):
    rows = _parsed_clauses(spark, sf).where(F.col("n_parts") > 1)
    return _big(_exploded(rows), "sentence_idx", "clause_idx", "attr_idx")


def topic_words(spark, sf):
    joined = F.array_join(topics.topic_words(F.col("sentence_kma")), " ")
    return _big(_tagged(spark, sf).select("doc_id", "sentence_idx", joined.alias("topics")), "sentence_idx")


def content_words(spark, sf):
    rows = tagging.with_word_tokens(_sentences(spark, sf), "sentence", W.small(spark, W.LEXICON), letters=LETTERS)
    kept = related.content_tokens(F.col("tokens"))
    found = rows.select(
        "doc_id", "sentence_idx", F.size(kept).alias("n_content"), related.content_word(F.col("tokens")).alias("content_word")
    )
    return _big(found, "sentence_idx", "n_content")


def normalize_hangul(spark, sf):
    """Texts turned into a mix of syllables and single Hangul letters, then put together again."""
    taken_apart = F.translate(F.lower("content"), "aeiountrsdl", "가베히오ㅜㄴ하ㄹㅅㄷㅏ")
    return W.plain_docs(spark, sf).select("doc_id", hangul.compose_jamo(taken_apart).alias("content"))


def close_words(spark, sf):
    marked = F.regexp_replace("content", " (the|th|de|der|la)", " <em>$1</em>")
    words = T.close_words(marked, LETTERS)
    found = W.plain_docs(spark, sf).select("doc_id", F.size(words).alias("n_words"), F.array_join(words, " ").alias("words"))
    return _big(found, "n_words")


def related_words(spark, sf):
    found = related.related_words(W.related_requests(spark, sf), W.crawl_doc(spark, sf, with_url=False), W.small(spark, W.LEXICON))
    return _big(found, "word_order")


# -- lookups and attributes ------------------------------------------------------------------------------

_ORDINALS = ["sentence_idx", "clause_idx"]


def emotion_exact(spark, sf):
    rows = _parsed_clauses(spark, sf).withColumn("verb", T.strip(F.col("verb")))
    found = lookup.exact_lookup(rows, F.col("verb"), lookup.emotion_dictionary(W.small(spark, W.VERB_DICT)), "emotion")
    return _big(found.select("doc_id", *_ORDINALS, "verb", "emotion"), *_ORDINALS)


def emotion_match(spark, sf):
    rows = _parsed_clauses(spark, sf)
    found = lookup.best_match(rows, F.col("verb"), lookup.emotion_dictionary(W.small(spark, W.VERB_DICT)), "emotion")
    return _big(found.select("doc_id", *_ORDINALS, "verb", "emotion"), *_ORDINALS)


def _subjects(spark, sf):
    return _exploded(_parsed_clauses(spark, sf))


def category_exact(spark, sf):
    dictionary = lookup.category_dictionary(W.small(spark, W.CATEGORY))
    return _big(lookup.exact_lookup(_subjects(spark, sf), F.col("subject"), dictionary, "category"), *_ORDINALS, "attr_idx")


def category_match(spark, sf):
    dictionary = lookup.category_dictionary(W.small(spark, W.CATEGORY))
    return _big(lookup.best_match(_subjects(spark, sf), F.col("subject"), dictionary, "category"), *_ORDINALS, "attr_idx")


def attribute_rows(spark, sf):
    found = jobs.attribute_rows(_tagged(spark, sf), W.small(spark, W.VERB_DICT), W.small(spark, W.CATEGORY))
    return _big(found, *_ORDINALS, "attr_idx")


def clause_sentiment(spark, sf):
    found = clauses.clause_sentiments(_tagged(spark, sf), W.small(spark, W.VERB_DICT))
    return _big(found.select("doc_id", *_ORDINALS, "clause_sentiment"), *_ORDINALS)


def clause_documents(spark, sf):
    return jobs.clause_documents(_tagged(spark, sf), W.small(spark, W.VERB_DICT))


def _survey_tagged(spark, sf):
    return jobs.survey_sentences(W.survey(spark, sf), W.small(spark, W.LEXICON), LETTERS)


def survey_attributes(spark, sf):
    found = jobs.survey_attributes(_survey_tagged(spark, sf), W.small(spark, W.VERB_DICT), W.small(spark, W.CATEGORY))
    return _big(found, *_ORDINALS, "attr_idx")


def survey_documents(spark, sf):
    return jobs.survey_documents(_survey_tagged(spark, sf), W.small(spark, W.VERB_DICT))


def tagged_records(spark, sf):
    spark = session_for_repeated_texts(spark)
    keyed = W.plain_docs(spark, sf).withColumn("text", F.col("content"))
    keyed = keyed.withColumn("content", T.without_line_breaks(F.col("text")))
    tagged = jobs.tagged_sentences(keyed, W.small(spark, W.LEXICON), ["doc_id", "content"], "content", letters=LETTERS)
    return jobs.tagged_records(tagged, W.small(spark, W.VERB_DICT), W.small(spark, W.CATEGORY), W.RECORD_DATE)


# -- payloads --------------------------------------------------------------------------------------------

def _tagging_records(spark, sf):
    docs = W.spread(W.load(spark, sf, "documents")).select(F.col("doc_id").cast("string"), "text", "lang", "source")
    tagged = tagging.tag_sentences(docs, W.small(spark, W.LEXICON), ["doc_id"], "text", "kma", LETTERS)
    return W.tagging_records(tagged)


def payload_quality(spark, sf):
    checked = payload.record_quality(payload.cleaned_records(_tagging_records(spark, sf), strip_ends=True))
    return checked.select("doc_id", "quality", "content")


def corpus_lines(spark, sf):
    return jobs.corpus(_tagging_records(spark, sf))


def cause_spans(spark, sf):
    records = payload.cleaned_records(W.matching_records(W.plain_docs(spark, sf)))
    found = spans.cause_spans(records, ["doc_id", "content"])
    shown = found.select("doc_id", "content", "cause_idx", "start", "value", "matched_text", "span")
    return _big(shown, "cause_idx", "start", "span")


def cause_verbs(spark, sf):
    records = payload.cleaned_records(W.matching_records(W.plain_docs(spark, sf)))
    found = jobs.cause_verbs(
        records, W.small(spark, W.VERB_DICT), jobs.cause_analyser(W.small(spark, W.LEXICON), LETTERS), ["doc_id", "content"],
    )
    return _big(found, "cause_idx", "verb_idx")


# -- files -----------------------------------------------------------------------------------------------

def xml_records(spark, sf):
    """Documents written as XML records without a root, then read back."""
    path = fresh_path(spark, "xml")
    escape = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    docs = W.plain_docs(spark, sf)
    record = F.concat(
        F.lit("<Doc><DocId> "), "doc_id", F.lit("\n</DocId><Content>"), escape(F.col("content")),
        F.lit('</Content><JSON>"result":[]</JSON></Doc>'),
    )
    sinks.write_lines(docs.select(record.alias("value")), path)
    return payload.cleaned_records(sources.read_rootless_xml(spark, path)).withColumnRenamed("JSON", "payload")


def ingested_records(spark, sf):
    """Tagged documents written as XML records without a root, and taken in with the state of each record."""
    path, out = fresh_path(spark, "xml"), fresh_path(spark, "ingested")
    escape = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    fields = [F.concat(F.lit(f"<{name}>"), escape(F.coalesce(name, F.lit(""))), F.lit(f"</{name}>")) for name in ("DocId", "Content", "JSON")]
    sinks.write_lines(_tagging_records(spark, sf).select(F.concat(F.lit("<Doc>"), *fields, F.lit("</Doc>")).alias("value")), path)
    taken = ingest.ingest_records(spark, path, out)
    return taken.records.select("doc_id", F.col("state").alias("quality"), "content")


def xml_rooted_records(spark, sf):
    """Documents written as XML files with a root element, then read back."""
    path = fresh_path(spark, "rooted")
    docs = W.plain_docs(spark, sf).select(F.col("doc_id").alias("DocId"), F.col("content").alias("Content"), F.lit('"result":[]').alias("JSON"))
    docs.write.options(rootTag="Result", rowTag="Doc").xml(path)
    return payload.cleaned_records(sources.read_xml(spark, path)).withColumnRenamed("JSON", "payload")


def positional_sheet(spark, sf):
    """Topics of the first column of sheets whose columns are found by place, next to the column that follows it."""
    path = fresh_path(spark, "positional")
    survey = W.survey(spark, sf)
    rows = survey.select("comment", F.concat_ws("_", "case_id", "response_id").alias("row_key"), "answer_id", "language_id")
    sinks.write_delimited(rows, path, sep=",", header=True)
    sheet = sources.read_positional_sheet(spark, path, 2)
    text, key = sheet.columns
    listed = jobs.topic_lists(sheet.withColumnRenamed(key, "row_key"), W.small(spark, W.LEXICON), ["row_key"], text, LETTERS)
    found = listed.select("row_key", F.posexplode_outer("topics").alias("i", "topic")).where(F.col("i").isNotNull())
    return found.select("row_key", (F.col("i") + 2).cast("bigint").alias("column_idx"), "topic")


def charset_ingest(spark, sf):
    """Whole texts with Hangul in them written as lines in cp949, rewritten as UTF-8, and read back."""
    legacy, utf8 = fresh_path(spark, "cp949"), fresh_path(spark, "utf8")
    text = F.concat_ws("|", "doc_id", F.translate("content", "aeiou", "가나다라마"))
    sources.write_legacy_lines(W.plain_docs(spark, sf).select(sources.legacy_text(text).alias("value")), legacy)
    sources.convert_to_utf8(spark, legacy, utf8)
    return spark.read.text(utf8).select(sources.restored_text(F.col("value")).alias("value"))


def survey_scan(spark, sf):
    """Two sheets with different column orders, read by header name."""
    survey = W.survey(spark, sf)
    users, others = fresh_path(spark, "sheet"), fresh_path(spark, "sheet")
    by_user = F.col("answer_id") == "user"
    sinks.write_delimited(survey.where(by_user), users, sep=",", header=True)
    sinks.write_delimited(survey.where(~by_user).select(*reversed(survey.columns)), others, sep=",", header=True)
    return sources.read_survey_sheets(spark, [users, others])


def recursive_scan(spark, sf):
    """A tree of folders, read with the path of every row's file."""
    path = fresh_path(spark, "tree")
    survey = W.survey(spark, sf).select("case_id", "response_id", "answer_id", F.translate("comment", "\r\n", "  ").alias("comment"))
    survey.withColumn("folder", F.col("answer_id")).write.partitionBy("folder").options(escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    rows = sources.read_tree(spark, path, "case_id string, response_id string, answer_id string, comment string", escape='"')
    return rows.select(
        "case_id", "response_id", "answer_id", "comment",
        F.regexp_extract("file_path", "/folder=([^/]*)/", 1).alias("folder"),
    )


def topic_columns(spark, sf):
    """Topics of every comment, numbered as the columns after the two source columns."""
    sheet = W.survey(spark, sf).select("comment", F.concat_ws("_", "case_id", "response_id").alias("row_key"))
    listed = jobs.topic_lists(sheet, W.small(spark, W.LEXICON), ["row_key"], "comment", LETTERS)
    found = listed.select("row_key", F.posexplode_outer("topics").alias("i", "topic")).where(F.col("i").isNotNull())
    return found.select("row_key", (F.col("i") + 2).cast("bigint").alias("column_idx"), "topic")


# -- dictionaries above the size limits, made from the documents -----------------------------------------

def _document_words(spark, sf):
    words = F.explode(F.array_distinct(tagging._words(F.col("text"), LETTERS)))
    return W.spread(W.load(spark, sf, "documents")).select(words.alias("word")).distinct()


def _large_lexicon(spark, sf):
    """Every distinct word of the documents, tagged by its length."""
    kind = F.char_length("word") % 3
    piece = F.when(kind == 0, F.concat("word", F.lit("/VV+다/EM"))).when(kind == 1, F.concat("word", F.lit("/NNG+은/J_"))).otherwise(F.concat("word", F.lit("/MAG")))
    token_type = F.when(kind == 0, "VV").when(kind == 1, "NNG").otherwise("MAG")
    return _document_words(spark, sf).select("word", piece.alias("piece"), token_type.alias("token_type"))


def content_words_large(spark, sf):
    """Content words of comments, by a word list of every distinct word of the documents."""
    keys = ["case_id", "response_id", "answer_id"]
    rows = tagging.with_word_tokens(W.survey(spark, sf).select(*keys, "comment"), "comment", _large_lexicon(spark, sf), letters=LETTERS)
    tokens = F.col("tokens")
    last = F.element_at(F.transform(tokens, lambda t: t["end_offset"]), -1)
    n_opening = F.size(F.filter(tokens, lambda t: t["particle"]))
    found = rows.select(*keys, related.content_word(tokens).alias("content_word"), F.coalesce(last, F.lit(0)).alias("n_chars"), n_opening.alias("n_opening"))
    return _big(found, "n_chars", "n_opening")


def tag_tokens_large(spark, sf):
    """Comments tagged with every distinct word of the documents."""
    lexicon = _large_lexicon(spark, sf)
    keys = ["case_id", "response_id", "answer_id"]
    tagged = tagging.tag_sentences(W.survey(spark, sf), lexicon, keys, "comment", letters=LETTERS)
    return tagged.select(*keys, "sentence_kma")


def emotion_match_large(spark, sf):
    """Comments matched with every distinct word of the documents."""
    emotion = F.concat(F.lit("e"), (F.char_length("word") % 5).cast("string"))
    verbs = _document_words(spark, sf).select(F.col("word").alias("verb"), emotion.alias("emotion"))
    found = lookup.best_match(W.survey(spark, sf), F.col("comment"), lookup.emotion_dictionary(verbs), "emotion")
    return found.select("case_id", "response_id", "answer_id", "emotion")


def category_match_large(spark, sf):
    """Comments matched with categories that have many rows each: the first lines of the documents by source and language."""
    category = W.load(spark, sf, "documents").select(
        F.col("source").alias("category_eng"), F.col("lang").alias("category_kor"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("synonym"), F.col("lang").alias("subtopic_code"),
    )
    found = lookup.best_match(W.survey(spark, sf), F.col("comment"), lookup.category_dictionary(category), "category")
    return found.select("case_id", "response_id", "answer_id", "category")


def _benchmark_rules(spark, sf):
    """A rule for each pair of neighbouring words of each item: the pair, and the word after it."""
    words = F.split(F.btrim(T.padded(F.col("text"))), " ", -1)
    rows = W.load(spark, sf, "benchmark").select("item_id", F.posexplode(words).alias("i", "first"), words.alias("words"))
    second, third = F.get("words", F.col("i") + 1), F.get("words", F.col("i") + 2)
    rules = rows.where(third.isNotNull()).select(
        F.col("item_id").cast("int").alias("dataset_seq"), F.lit("Y").alias("use_yn"), F.concat_ws(" ", "first", second).alias("keyword"), third.alias("sub_keywords")
    )
    return rules.select("*", *[F.lit("").alias(name) for name in ("title_filter_keywords", "content_filter_keywords", "filter_urls")])


def dataset_match_large(spark, sf):
    """Documents matched with thousands of rules made from the benchmark texts, frequent words among them."""
    found = matching.match_datasets(W.crawl_doc(spark, sf), _benchmark_rules(spark, sf), max_in_plan=256)
    return _big(found.select("dataset_seq", "doc_id"), "dataset_seq")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        channel_filter, date_range_filter, dataset_match, dataset_exclusion, url_exclusion, filter_documents, filter_documents_stored,
        pending_requests, request_type_names, request_datasets, export_pages, export_manifest, exported_files, request_status,
        sentences, sentences_multi, clean_text, tag_tokens, strip_tags, conjunct_subjects, topic_words, content_words,
        normalize_hangul, close_words, related_words, emotion_exact, emotion_match, category_exact, category_match,
        attribute_rows, clause_sentiment, clause_documents, survey_attributes, survey_documents, tagged_records,
        payload_quality, corpus_lines, cause_spans, cause_verbs, xml_records, ingested_records, charset_ingest, survey_scan,
        recursive_scan, topic_columns, xml_rooted_records, positional_sheet, tag_tokens_large, content_words_large, emotion_match_large, category_match_large, dataset_match_large,
    )
}
QUERIES["clauses"] = clause_rows
