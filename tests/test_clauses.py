import pytest
from pyspark.sql import functions as F

from docweave.operators import clauses, tagging
from docweave.plans import jobs

VERBS = [("싸 다", "긍정"), ("비싸 다", "부정"), ("느리다", "부정"), ("좋다", "긍정2")]
CATEGORIES = [("price", "가격", "값", "C01"), ("service", "서비스", "응대", "C02"), ("car", "차", "자동차 차량", "C03")]


@pytest.fixture(scope="module")
def dictionaries(spark):
    verbs = spark.createDataFrame(VERBS, "verb string, emotion string")
    return verbs, spark.createDataFrame(
        CATEGORIES, "category_eng string, category_kor string, synonym string, subtopic_code string"
    )


def attributes(spark, dictionaries, kma, **options):
    tagged = spark.createDataFrame([("d", 0, "문장", kma)], "doc_id string, sentence_idx int, sentence string, sentence_kma string")
    rows = clauses.extract_attributes(tagged, *dictionaries, **options).orderBy("clause_idx", "attr_idx").collect()
    return [(r.clause_idx, r.attr_idx, r.subject, r.verb, r.sentiment, r.category) for r in rows]


def test_one_particle(spark, dictionaries):
    got = attributes(spark, dictionaries, "가격/NNG+은/J_ 싸/VA 다/EF")
    assert got == [(0, 0, "가격", "싸 다", "긍정", "C01")]


def test_coordinated_subjects_share_the_verb(spark, dictionaries):
    got = attributes(spark, dictionaries, "가격/NNG+과/J_ 서비스/NNG+이/J_ 좋다/VA")
    assert got == [(0, 0, "가격", "좋다", "긍정2", "C01"), (0, 1, "서비스", "좋다", "긍정2", "C02")]


def test_empty_conjunct_stays(spark, dictionaries):
    assert [row[2] for row in attributes(spark, dictionaries, "과/J_ 값/NNG+도/J_ 싸/VA")] == ["", "값"]


def test_several_particles(spark, dictionaries):
    kma = "차/NNG+는/J_ 값/NNG+이/J_ 비싸/VA 다/EF"
    assert attributes(spark, dictionaries, kma) == [(0, 0, "값", "값", "", "C01")]
    assert attributes(spark, dictionaries, kma, verb_part="last") == [(0, 0, "값", "비싸 다", "부정", "C01")]


def test_no_particle(spark, dictionaries):
    got = attributes(spark, dictionaries, "서비스/NNG 응대/NNG 느리/VA+다/EF")
    assert got == [(0, 0, "서비스", " 느리다", "부정", "C02"), (0, 1, "응대", " 느리다", "부정", "C02")]
    # Without a particle the whole text has to be a term: one word of "자동차 차량" is not enough.
    assert attributes(spark, dictionaries, "차량/NNG")[0][5] == ""


def test_only_verbs_keep_a_row_without_subject(spark, dictionaries):
    assert attributes(spark, dictionaries, "싸/VA 다/EM+z/VV") == []


def test_empty_tagged_text_gives_an_empty_subject(spark, dictionaries):
    assert attributes(spark, dictionaries, "") == [(0, 0, "", "", "", "")]


def test_sentence_without_clauses_keeps_a_row(spark, dictionaries):
    assert attributes(spark, dictionaries, "/EM ") == [(None, None, None, None, None, None)]
    survey = spark.createDataFrame(
        [("c", "r", "a", "l", "글", 0, "글", "/EM ")],
        "case_id string, response_id string, answer_id string, language_id string, content string, sentence_idx int, sentence string, sentence_kma string",
    )
    row = jobs.survey_documents(survey, dictionaries[0]).first()
    assert row.id == "c_r_a_l_0" and '"sentence_kma":"","sentiment":""' in row.document
    rows = jobs.survey_attributes(survey, *dictionaries).collect()
    assert [(r.content, r.clause, r.subject) for r in rows] == [("글", None, None)]


def test_connective_splits_clauses(spark, dictionaries):
    got = attributes(spark, dictionaries, "값/NNG+이/J_ 싸/VA 고/EM 차/NNG+는/J_ 느리다/VA")
    assert [(r[0], r[2], r[4], r[5]) for r in got] == [(0, "값", "긍정", "C01"), (1, "차", "부정", "C03")]


def test_clause_text_and_letters(spark):
    tagged = spark.createDataFrame([("하ㄴ/VV 고/EM 가ㅂ니다/VV", "x.")], "sentence_kma string, sentence string")
    got = clauses.split_clauses(tagged).orderBy("clause_idx").collect()
    assert [r.clause for r in got] == ["한 고", "갑니다"]


@pytest.mark.parametrize(
    ("labels", "expected"),
    [(["긍정", "부정"], "부정"), ([" 긍정 ", ""], "긍정"), (["긍정2"], "중립"), ([], "중립")],
)
def test_clause_label(spark, labels, expected):
    rows = spark.createDataFrame([(labels,)], "s array<string>")
    assert rows.select(clauses.clause_label(F.col("s"))).first()[0] == expected


def test_sentences_are_stripped_and_keep_their_ordinals(spark):
    docs = spark.createDataFrame([("d", "가. \u3000.나 ")], "doc_id string, t string")
    got = [(r.sentence_idx, r.sentence) for r in clauses.split_sentences(docs, ["doc_id"], "t").collect()]
    assert got == [(0, "가"), (2, "나")]


def test_large_word_list_gives_the_same_tags(spark):
    lexicon = spark.createDataFrame([("값이", "값/NNG+이/J_", "NNG"), ("싸다", "싸/VA", "VA")], "word string, piece string, token_type string")
    rows = spark.createDataFrame([(1, "값이 정말 싸다!"), (2, ""), (3, "싸다 값이")], "k int, sentence string")
    small = tagging.tag_sentences(rows, lexicon, ["k"]).orderBy("k").collect()
    large = tagging.tag_sentences(rows, lexicon, ["k"], max_in_plan=0).orderBy("k").collect()
    assert [r.sentence_kma for r in small] == [r.sentence_kma for r in large] == ["값/NNG+이/J_ 정말/NNG 싸/VA", "", "싸/VA 값/NNG+이/J_"]


def test_documents_are_valid_json(spark, dictionaries):
    import json

    tagged = spark.createDataFrame([("d", 3, "그의 '값'\"이\"", "값/NNG+이/J_ 싸/VA 다/EF")], "doc_id string, sentence_idx int, sentence string, sentence_kma string")
    row = jobs.clause_documents(tagged, dictionaries[0]).first()
    document = json.loads(row.document)
    assert document["_id"] == row.id == "d_3_0"
    assert document["_source"] == {"sentence": "그의 '값'\"이\"", "sentence_kma": "값/NNG+이/J_ 싸/VA 다/EF", "sentiment": "긍정"}


def test_a_clause_is_split_by_particles_once(spark):
    rows = spark.createDataFrame([("가격/NNG+은/J_ 싸/VA", 0)], "clause_kma string, clause_idx int")
    plan = clauses.add_subjects_and_verb(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("/J_") == 1


def test_plain_clauses_are_parsed_like_others(spark):
    """A single letter makes a text one that is not plain; a clause without letters or blanks must give the same words."""
    kma = ["a/NNG b/VV  c/XSD+d/EM e", "/VV", "", " ", "x/NNG y/VA ", "a/NNG+은/J_ b/VV 다/EF", "a/NNG+와/J_ b은/J_c", "é/VV f/VVVV+/EMx", "가/J_도/J_ ", "은/J_"]
    texts = spark.createDataFrame([(i, k) for i, k in enumerate(kma)], "i int, clause_kma string")
    # A word of its own at the end, with a letter that stays single.
    marked = texts.withColumn("clause_kma", F.concat("clause_kma", F.lit(" ㅎ/NNG")))
    plain = texts.withColumn("clause_kma", F.concat("clause_kma", F.lit(" Q/NNG")))
    both = [clauses.add_subjects_and_verb(df).orderBy("i").collect() for df in (plain, marked)]
    seen = [[(r.n_parts, r.verb.replace("ㅎ", "Q"), [s.replace("ㅎ", "Q") for s in r.subjects]) for r in rows] for rows in both]
    assert seen[0] == seen[1]
    blanks = spark.createDataFrame([("\u00a0a\t/NNG b\u3000/VV\x1c",)], "clause_kma string")
    row = clauses.add_subjects_and_verb(blanks).first()
    assert row.subjects == ["a\t"] and row.verb == " b\u3000"
