import json

import pytest
from pyspark.sql import functions as F

from docweave.functions.tags import KOREAN_AND_LATIN
from docweave.operators import payload, related, spans, tagging
from docweave.plans import jobs

TOKEN = "array<struct<token:string,type:string,start_offset:int,end_offset:int,position:int,particle:boolean>>"


def result(sentence, begin, *values):
    return {"sentence": {"string": sentence}, "matched_text": {"string": sentence, "begin": begin}, "variables": [{"value": v} for v in values]}


def body(results):
    return json.dumps({"result": results}, ensure_ascii=False)[1:-1]


def test_spans_sort_by_start_and_close_at_the_next_cause(spark):
    records = spark.createDataFrame(
        [("d", body([result("가나다라마바사아", 7, "x", "y"), result("abc", 2, "z")])), ("e", '"result":[]'), ("f", "broken")],
        "doc_id string, JSON string",
    )
    got = spans.cause_spans(records, ["doc_id"]).orderBy("doc_id", "cause_idx").collect()
    # start = ceil(begin / 2); equal starts leave the first cause an empty span; the last one ends with its sentence.
    assert [(r.doc_id, r.cause_idx, r.start, r.value, r.span) for r in got] == [
        ("d", 0, 1, "z", 3), ("d", 1, 4, "x", 0), ("d", 2, 4, "y", 4),
    ]


def tok(token, kind, start, position, particle=False):
    return (token, kind, start, start + len(token.split("/")[0]), position, particle)


def test_words_with_a_particle_absorb_what_follows(spark):
    tokens = [
        tok("좋/VA", "VA", 0, 0), tok("가격이", "EOJEOL", 2, 1, True), tok("가격", "NNG", 2, 1), tok("싸/VA", "VA", 6, 2),
        tok("값은", "EOJEOL", 8, 3, True), tok("값", "NNG", 8, 3), tok("좋/VA", "VA", 90, 9),
    ]
    rows = spark.createDataFrame([("d", 0, "v", "text", 20, tokens)], f"doc_id string, cause_idx int, value string, matched_text string, span int, t {TOKEN}")
    verbs = spark.createDataFrame([("좋다", "긍정"), ("값", "부정")], "verb string, emotion string")
    analyse = lambda rows, text_col, out_col: rows.withColumn(out_col, F.col("t"))
    got = spans.cause_verbs(rows, verbs, analyse, ["doc_id"]).orderBy("verb_idx").collect()
    assert [(r.verb, r.emotion) for r in got] == [("좋/VA", "긍정"), ("가격", ""), ("값", "부정")]


def test_last_entry_of_a_token_wins(spark):
    rows = spark.createDataFrame([([("a", "VV"), ("b", "VA"), ("a", "NNG")],)], "k array<struct<token:string,type:string>>")
    got = rows.select(spans.last_per_token(F.col("k"))).first()[0]
    assert [(i.token, i.type) for i in got] == [("b", "VA"), ("a", "NNG")]


def test_corpus_and_quarantine(spark):
    records = spark.createDataFrame(
        [
            (" a\r\n1", "글\n", '"result":[{"kma":"값/NNG+이/J_ 싸/VA"},{"kma":"no"}]'), ("b", "x", '"result":[{"kma":'),
            ("c", "x", '"result":[]'), ("d", "x", '"other":1'),
        ],
        "DocId string, Content string, JSON string",
    )
    assert {r.doc_id: r.line for r in jobs.corpus(records).collect()} == {"a1": "값/NNG 이/J_ 싸/VA ", "b": ""}
    cleaned = payload.cleaned_records(records)
    assert {r.doc_id: r.quality for r in payload.record_quality(cleaned).collect()} == {
        "a1": "ok", "b": "undecodable", "c": "no_result", "d": "no_result",
    }
    bad = payload.quarantine(cleaned).collect()
    assert [(r.doc_id, r.broken) for r in bad] == [("b", '{"result":[{"kma":}')]


@pytest.mark.parametrize(("attached", "expected"), [(True, ["작은", "흠집을"]), (False, [])])
def test_related_words_with_attached_letters(spark, attached, expected):
    docs = spark.createDataFrame([("d", "제목", "파란 우산 손잡이에서 작은 작은 흠집을 a"), ("e", "파란", "x")], "doc_id string, doc_title string, doc_content string")
    asked = spark.createDataFrame([("d", "우산 손잡이"), ("zz", "x")], "doc_id string, term string")
    got = related.related_words(asked, docs, attached=attached).orderBy("word_order").collect()
    assert [r.word for r in got] == (["파란", *expected] if attached else [])


def test_related_words_order_and_fragment_limit(spark):
    text = " ".join(f"key word{i:02d} filler{i:02d} filler{i:02d}" for i in range(8))
    docs = spark.createDataFrame([("d", "title key end", text)], "doc_id string, doc_title string, doc_content string")
    asked = spark.createDataFrame([("d", "key"), ("d", "")], "doc_id string, term string")
    got = [r.word for r in related.related_words(asked, docs, fragment_limit=2).orderBy("word_order").collect()]
    assert got[:3] == ["title", "end", "word00"] and "word07" not in got and len(got) == len(set(got))


def test_tags_are_the_same_on_both_ways_for_null_and_repeated_keys(spark):
    lexicon = spark.createDataFrame([("값", "값/NNG", "NNG"), ("싸다", "싸/VA+다/EF", "VA")], "word string, piece string, token_type string")
    rows = spark.createDataFrame([(None, "값 싸다"), (None, "모름"), (1, "값"), (1, "싸다 값"), (1, "값"), (2, ""), (3, None)], "k int, sentence string")
    both = [
        sorted(map(str, tagging.tag_sentences(rows, lexicon, ["k"], max_in_plan=limit).collect())) for limit in (4096, 0)
    ]
    assert both[0] == both[1] and len(both[0]) == 7


def test_offsets_and_tokens_grow_with_the_words(spark):
    import time

    none = spark.createDataFrame([], "word string, piece string, token_type string")

    def seconds(n):
        text = spark.range(1).select(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("가"), i.cast("string"))), " ").alias("t"))
        text = text.repartition(1)
        analysed = tagging.with_word_tokens(text, "t", none)
        tokens = F.col("tokens")
        start = time.perf_counter()
        kept = spans.last_per_token(spans.described_tokens(tokens, F.lit(10_000_000)))
        last = analysed.select(F.size(kept).alias("n"), F.element_at(tokens, -1)["end_offset"].alias("end"), F.char_length("t").alias("size")).first()
        assert last.n == n and last.end == last.size
        return time.perf_counter() - start

    seconds(1_000)
    assert seconds(40_000) < 3 * seconds(20_000) + 2


def test_a_word_with_any_number_of_tokens_keeps_them_all(spark):
    """Twenty tokens of a word with a particle stay, those of a later word without one do not."""
    parts = [tok(f"부분{i}", "NNG", 2, 1) for i in range(20)]
    tokens = [tok("앞", "NNG", 0, 0), tok("가격이", "EOJEOL", 2, 1, True), *parts, tok("뒤", "EOJEOL", 6, 2), tok("뒤", "NNG", 6, 2), tok("값은", "EOJEOL", 8, 3, True), tok("값", "NNG", 8, 3)]
    rows = spark.createDataFrame([(tokens,)], f"t {TOKEN}")
    got = rows.select(spans.described_tokens(F.col("t"), F.lit(50))).first()[0]
    assert [t.token for t in got] == ["앞", *(p[0] for p in parts), "값"]


LEXICON = [("값", "값/NNG+은/J_", "NNG"), ("싸다", "싸/VA+다/EF", "VA"), ("및", "및/MA", "MAJ"), ("및", "및/X", "NNG")]


def test_tokens_and_content_words_are_the_same_on_both_ways(spark):
    lexicon = spark.createDataFrame(LEXICON, "word string, piece string, token_type string")
    rows = spark.createDataFrame([(None, "값 싸다 및"), (None, "모름, 값"), (1, "값"), (1, "값"), (2, ""), (3, None)], "k int, s string")
    tokens = [sorted(map(str, tagging.with_word_tokens(rows, "s", lexicon, max_in_plan=limit).collect())) for limit in (4096, 0)]
    assert tokens[0] == tokens[1] and len(tokens[0]) == 6
    words = rows.select("k", F.split("s", " ").alias("w"))
    content = [sorted(map(str, tagging.with_content_words(words, "w", lexicon, "c", ["MAJ"], limit).collect())) for limit in (4096, 0)]
    assert content[0] == content[1] and any("c=['값', '싸다', '']" in row for row in content[0])


def test_a_lexicon_of_a_hundred_thousand_words(spark):
    lexicon = spark.range(100_000).select(
        F.concat(F.lit("w"), F.col("id").cast("string")).alias("word"),
        F.when(F.col("id") % 2 == 0, "x/NNG+y/J_").otherwise("x/VV").alias("piece"), F.when(F.col("id") % 2 == 0, "NNG").otherwise("VV").alias("token_type"),
    )
    rows = spark.createDataFrame([("w0 w1 w99999 zz",)], "s string")
    got = tagging.with_word_tokens(rows, "s", lexicon, letters=KOREAN_AND_LATIN).first().tokens
    assert [(t.token, t.type, t.start_offset, t.particle) for t in got] == [
        ("w0", "EOJEOL", 0, True), ("w0", "NNG", 0, False), ("w1", "EOJEOL", 3, False), ("w1/VV", "VV", 3, False),
        ("w99999", "EOJEOL", 6, False), ("w99999/VV", "VV", 6, False), ("zz", "EOJEOL", 13, False), ("zz", "NNG", 13, False),
    ]
    docs = spark.createDataFrame([("d", "t", "w2 key w3 zz")], "doc_id string, doc_title string, doc_content string")
    asked = spark.createDataFrame([("d", "key")], "doc_id string, term string")
    stopped = lexicon.withColumn("token_type", F.when(F.col("word") == "w3", "JX").otherwise(F.col("token_type")))
    assert [r.word for r in related.related_words(asked, docs, stopped).collect()] == ["w2", "zz"]



def test_causes_of_many_long_documents_are_stored_with_each_text_once(spark, tmp_path):
    # 400 texts of 6,000 letters that do not compress, ten causes each: 24 MB of repeated texts.
    letters = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(150)), lambda i: F.sha2(F.concat("id", i).cast("binary"), 256)), "")
    causes = body([result(f"word {i}", 80 * i, "x") for i in range(10)])
    docs = spark.range(0, 400, 1, 1).select(F.col("id").cast("string").alias("doc_id"), F.substring(letters, 1, 6000).alias("content"), F.lit(causes).alias("JSON"))
    found = spans.cause_spans(docs, ["doc_id", "content"])
    per_task = found.select("doc_id", "content", F.spark_partition_id().alias("p")).distinct().groupBy("p").agg(F.sum(F.length("content")).alias("n"))
    assert per_task.agg(F.max("n")).first()[0] < 1024 * 1024
    path = str(tmp_path / "causes")
    found.write.parquet(path)
    stored = sum(f.stat().st_size for f in (tmp_path / "causes").glob("*.parquet"))
    assert stored < 2 * 400 * 6000
    back = spark.read.parquet(path)
    assert back.count() == 4000 and back.join(docs, ["doc_id", "content"], "left_semi").count() == 4000


def test_causes_without_texts_or_documents(spark):
    docs = spark.createDataFrame([(None, None, body([result("abc", 2, "z")])), (None, None, body([result("abc", 2, "z")]))], "doc_id string, content string, JSON string")
    assert [(r.doc_id, r.content, r.value) for r in spans.cause_spans(docs, ["doc_id", "content"]).collect()] == [(None, None, "z")] * 2
    assert spans.cause_spans(docs.where("doc_id = 'x'"), ["doc_id", "content"]).collect() == []


def test_only_causes_with_a_span_are_analysed(spark):
    rows = spark.createDataFrame(
        [("d", 0, "v", "값 싸다", 0), ("d", 1, "v", "값 싸다", 4), ("d", 2, "v", "값", -7), (None, 3, "v", "값", None), (None, 4, None, "값", 1)],
        "doc_id string, cause_idx int, value string, matched_text string, span int",
    )
    lexicon = spark.createDataFrame(LEXICON, "word string, piece string, token_type string")
    verbs = spark.createDataFrame([("싸다다", "긍정")], "verb string, emotion string")
    given = []

    def analyse(rows, text_col, out_col):
        given.append(sorted(r.cause_idx for r in rows.collect()))
        return jobs.word_analyser(lexicon)(rows, text_col, out_col)

    got = spans.cause_verbs(rows, verbs, analyse, ["doc_id"]).collect()
    assert given == [[1, 4]]
    # The second cause's first word has a particle, so its second word describes something else.
    assert sorted(map(str, ((r.doc_id, r.cause_idx, r.value, r.verb_idx, r.verb, r.emotion) for r in got))) == sorted(
        map(str, [("d", 1, "v", 0, "값", ""), (None, 4, None, 0, "값", "")])
    )


@pytest.mark.parametrize("limit", [4096, 0])
def test_tokens_that_can_matter_give_the_same_verbs(spark, limit):
    import random

    chance = random.Random(3)
    lexicon = spark.createDataFrame([*LEXICON, ("는", "는/J_", "JX"), ("은", "은/J_", None)], "word string, piece string, token_type string")
    words = ["값", "싸다", "및", "는", "은", "모름", "don't", "a\nb", "É c", "x,y", "  ", "漢", "값\r\n", "."]
    texts = [None, "", " .", *[chance.choice(["", " "]).join([chance.choice(words) + " " for _ in range(n)]) for n in (1, 2, 3, 5, 8, 13, 40, 200, 300) for _ in range(4)]]
    rows = spark.createDataFrame(
        [(text, span) for text in texts for span in (None, -1, 0, 1, 2, 3, 7, 20, 41, 600, 2**31 - 1)], "t string, span int"
    )
    kept = spans.last_per_token(spans.described_tokens(F.col("tokens"), F.col("span"))).alias("kept")
    every = tagging.with_word_tokens(rows, "t", lexicon, max_in_plan=limit)
    few = tagging.with_word_tokens(rows, "t", lexicon, max_in_plan=limit, within="span", types=spans.KEPT_TYPES)
    shown = lambda df: sorted(map(str, df.select("t", "span", kept).collect()))
    assert shown(few) == shown(every)
    # Only such tokens are made, each as it is among all.
    needed = lambda t: (t["end_offset"] <= F.col("span")) & (t["type"].isin(*spans.KEPT_TYPES) | ((t["type"] == "EOJEOL") & t["particle"]))
    made = lambda df, tokens: sorted(map(str, df.select("t", "span", tokens).collect()))
    assert made(few.where("span is not null"), F.col("tokens")) == made(every.where("span is not null"), F.filter("tokens", needed).alias("tokens"))
    assert few.where("span is null and size(tokens) > 0").isEmpty()


def test_sums_on_both_sides_of_a_block(spark):
    from docweave.functions.dictionary import SUM_BLOCK, sums_before

    for n in (0, 1, SUM_BLOCK - 1, SUM_BLOCK, SUM_BLOCK + 1, 3 * SUM_BLOCK):
        values = [i % 7 for i in range(n)]
        got = spark.createDataFrame([(values,)], "v array<int>").select(sums_before(F.col("v"))).first()[0]
        assert got == [sum(values[:i]) for i in range(n)]
