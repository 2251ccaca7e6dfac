import json
from datetime import datetime

import pytest

from docweave.functions.tags import KOREAN_AND_LATIN
from docweave.plans import folders, jobs
from docweave.scratch import fresh_path

LEXICON = [("값이", "값/NNG+이/J_", "NNG"), ("싸다", "싸/VA+다/EM", "VA"), ("맛은", "맛/NNG+은/J_", "NNG"), ("좋다", "좋/VA+다/EF", "VA")]


@pytest.fixture(scope="module")
def words(spark):
    return folders.Dictionaries(
        spark.createDataFrame(LEXICON, "word string, piece string, token_type string"),
        spark.createDataFrame([("싸", "긍정"), ("좋", "긍정"), ("좋다", "긍정"), ("싸다", "긍정")], "verb string, emotion string"),
        spark.createDataFrame([("price", "값", "요금", "C1"), ("taste", "맛", "풍미", "C2")], "category_eng string, category_kor string, synonym string, subtopic_code string"),
        KOREAN_AND_LATIN,
    )


def xml(records):
    return "<Result>" + "\n".join(f"<Doc><DocId>{i}</DocId><Content>{c}</Content><JSON>{j}</JSON></Doc>" for i, c, j in records) + "</Result>"


CAUSE = '"result":[{"sentence":{"string":"값이 싸다"},"matched_text":{"string":"값이 싸다","begin":0},"variables":[{"value":"v"}]}]'


@pytest.fixture
def xml_dir(tmp_path):
    (tmp_path / "in" / "아래 +x").mkdir(parents=True)
    (tmp_path / "in" / "a.b.xml").write_text(xml([("1", "값이 싸다. 맛은 좋다", CAUSE)]), encoding="utf-8")
    (tmp_path / "in" / "아래 +x" / "둘.xml").write_text(xml([("1", "맛은 좋다", CAUSE), ("2", "값이 싸다", '"result":[]')]), encoding="utf-8")
    return str(tmp_path / "in")


@pytest.fixture
def sheet_dir(tmp_path):
    (tmp_path / "sheets").mkdir()
    (tmp_path / "sheets" / "one.csv").write_text('case_id,response_id,answer_id,language_id,comment\n1,2,3,ko,"값이 싸다\n"\n', encoding="utf-8")
    (tmp_path / "sheets" / "two.csv").write_text("comment,language_id,answer_id,response_id,case_id\n맛은 좋다,ko,30,20,10\n", encoding="utf-8")
    return str(tmp_path / "sheets")


def outputs(spark, out, **options):
    """Rows by output name: cells of delimited ones, else lines."""
    read = spark.read.options(multiLine=True, escape='"', **options).csv(out) if options else spark.read.text(out)
    found = {}
    for row in read.collect():
        found.setdefault(row.output, []).append(tuple(row)[:-1] if options else row[0])
    return {name: sorted(rows, key=str) for name, rows in found.items()}


XML_NAMES = ["a.b{}", "아래 +x/둘{}"]


def named(extension):
    return {name.format(extension) for name in XML_NAMES}


def test_attribute_rows(spark, xml_dir, words):
    out = fresh_path(spark, "out")
    folders.attribute_rows(spark, xml_dir, out, words)
    got = outputs(spark, out, sep="\t")
    assert set(got) == named(".result")
    assert [(r[0], r[3], r[6]) for r in got["a.b.result"]] == [("1", "값", "C1"), ("1", "맛", "C2")]
    assert [(r[0], r[3]) for r in got["아래 +x/둘.result"]] == [("1", "맛"), ("2", "값")]


def test_cause_verbs(spark, xml_dir, words):
    out = fresh_path(spark, "out")
    folders.cause_verbs(spark, xml_dir, out, words)
    got = outputs(spark, out, sep="\t")
    assert set(got) == named(".result")
    assert got["a.b.result"] == [("1", "값이 싸다. 맛은 좋다", "v", "값이", None)]


def test_clause_documents_and_tagged_records(spark, xml_dir, words):
    out = fresh_path(spark, "out")
    folders.clause_documents(spark, xml_dir, out, words)
    got = outputs(spark, out)
    assert set(got) == named(".json")
    assert [json.loads(line)["_id"] for line in got["아래 +x/둘.json"]] == ["1_0_0", "2_0_0"]
    out = fresh_path(spark, "out")
    folders.tagged_records("20240101")(spark, xml_dir, out, words)
    got = outputs(spark, out)
    assert set(got) == named(".SCD") and len(got["a.b.SCD"]) == 2
    assert all(line.startswith("<DOCID>") and "<DATE>20240101<CONTENT>" in line for lines in got.values() for line in lines)


def test_surveys(spark, sheet_dir, words):
    out = fresh_path(spark, "out")
    folders.survey_attributes(spark, sheet_dir, out, words)
    got = outputs(spark, out, sep=";")
    assert {name: [r[:4] for r in rows] for name, rows in got.items()} == {"one.result": [("1", "2", "3", "ko")], "two.result": [("10", "20", "30", "ko")]}
    assert all(len(r) == 11 for rows in got.values() for r in rows)
    out = fresh_path(spark, "out")
    folders.survey_documents(spark, sheet_dir, out, words)
    ids = {name: [json.loads(line)["_id"] for line in lines] for name, lines in outputs(spark, out).items()}
    assert ids == {"one.json": ["1_2_3_ko_0_0"], "two.json": ["10_20_30_ko_0_0"]}


def test_a_single_file_and_a_second_run(spark, xml_dir, words):
    out = fresh_path(spark, "out")
    for _ in range(2):
        folders.attribute_rows(spark, f"{xml_dir}/a.b.xml", out, words)
    assert {name: len(rows) for name, rows in outputs(spark, out, sep="\t").items()} == {"a.b.result": 2}


def test_corpus_names(spark):
    records = spark.createDataFrame([("1", "글", '"result":[{"kma":"값/NNG+이/J_"}]')], "DocId string, Content string, JSON string")
    folder = fresh_path(spark, "corpus")
    path = folders.write_corpus(records, folder, datetime(2024, 3, 9, 7, 5, 30))
    assert path == f"{folder}/202403090705.txt"
    assert folders.write_corpus(records, folder, datetime(2024, 3, 9, 8), append_to=path) == path
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines == [jobs.corpus(records).first().line] * 2
