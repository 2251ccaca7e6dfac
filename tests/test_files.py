import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from docweave.operators import payload
from docweave.plans import ingest, jobs
from docweave.sinks import files as sinks
from docweave.sinks.rows import tagged_record, wide_topics
from docweave.sources import files as sources, sheets

RECORDS = [("1\r\n", "첫 <글> & 끝"), (" 2 ", "둘\n째"), ("3", "")]


def xml(records):
    clean = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")
    return [f'<Doc><DocId>{i}</DocId><Content>{clean(c)}</Content><JSON>"result":[]</JSON></Doc>' for i, c in records]


@pytest.mark.parametrize("gap", ["", "\n", " \r\n"])
def test_rootless_xml_loses_no_record(spark, tmp_path, gap):
    (tmp_path / "in.xml").write_text(gap.join(xml(RECORDS)) + gap, encoding="utf-8", newline="")
    got = payload.cleaned_records(sources.read_rootless_xml(spark, str(tmp_path))).collect()
    assert sorted((r.doc_id, r.content or "", r.JSON) for r in got) == [
        ("1", "첫 <글> & 끝", '"result":[]'), ("2", "둘째", '"result":[]'), ("3", "", '"result":[]'),
    ]


def test_rooted_xml(spark, tmp_path):
    (tmp_path / "in.xml").write_text("<Result>" + "\n".join(xml(RECORDS)) + "</Result>", encoding="utf-8")
    assert sources.read_xml(spark, str(tmp_path / "in.xml")).count() == 3


def test_legacy_charset(spark, tmp_path):
    lines = ["가나다 abc", '따옴표 " , 그리고', "똠방각하"]
    (tmp_path / "in.txt").write_bytes("\n".join(lines).encode("cp949"))
    assert [r.value for r in sources.read_legacy_lines(spark, str(tmp_path / "in.txt")).collect()] == lines
    out = str(tmp_path / "utf8")
    sources.convert_to_utf8(spark, str(tmp_path / "in.txt"), out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == sorted(lines)


def test_small_legacy_files_get_a_root(spark, tmp_path):
    (tmp_path / "in.xml").write_bytes("".join(xml([("1", "한글")])).encode("cp949"))
    whole = sources.add_xml_root(spark.read.format("binaryFile").load(str(tmp_path)))
    text = whole.first().value
    assert text.startswith("<?xml") and text.endswith("</Result>") and "한글" in text


def test_sheets_are_read_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('case_id,response_id,answer_id,language_id,comment\n1,2,3,ko,"여러\n줄, ""인용"""\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("comment,extra,language_id,answer_id,response_id,case_id\n좋아요,z,ko,30,20,10\n", encoding="utf-8")
    rows = sources.read_survey_sheets(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).orderBy("case_id").collect()
    assert [tuple(r) for r in rows] == [("1", "2", "3", "ko", '여러\n줄, "인용"'), ("10", "20", "30", "ko", "좋아요")]


def test_one_large_sheet_is_read_by_many_tasks(spark, tmp_path):
    """Cells with line breaks, quotes and separators, longer than a split: the rows that a whole reading gives."""
    rng = random.Random(2)
    cell = lambda: "".join(rng.choice(["a", "\n", '"', ",", " ", "가", "\n\n", ""]) for _ in range(rng.choice([0, 1, 5, 40])))
    rows = [[f"{i}", cell(), cell() if i % 97 else cell() + "\n" * 3_000 + '"', "end"] for i in range(2_000)]
    for name, newline in (("a.csv", "\n"), ("b.csv", "\r\n")):
        with open(tmp_path / name, "w", encoding="utf-8", newline="") as file:
            writer = csv.writer(file, lineterminator=newline)
            writer.writerows([["case_id", "comment", "note", "last"], *rows])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert sheets._lines(spark, [str(tmp_path / "a.csv")]).select("block").distinct().count() > 20
        got = sources.read_survey_sheets(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], ["case_id", "comment", "note", "last"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [tuple(value or None for value in row) for row in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want * 2, key=str)
    whole = spark.read.options(header=True, multiLine=True, escape='"').csv(str(tmp_path / "a.csv"))
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(want, key=str)


def test_sheets_of_odd_shapes(spark, tmp_path):
    for name, text in {"empty.csv": "", "header.csv": "a,b\n", "bom.csv": "\ufeffa,b\n1,2\n\n3\n4,5,6", "open.csv": 'b,a\n"x\ny,1\n'}.items():
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    rows = sources.read_survey_sheets(spark, [str(tmp_path / n) for n in ("empty.csv", "header.csv", "bom.csv")], ["b", "a", "c"]).collect()
    assert sorted(map(tuple, rows), key=str) == [("2", "1", None), ("5", "4", None), (None, "3", None)]
    assert sources.read_survey_sheets(spark, [str(tmp_path / "empty.csv")], ["a"]).collect() == []
    assert sources.read_survey_sheets(spark, [str(tmp_path / "open.csv")], ["b"]).count() == 1


def test_positional_sheet_and_topic_columns(spark, tmp_path):
    (tmp_path / "in.csv").write_text("문장,번호,기타\n값이 싸다,1,x\n,2,y\n", encoding="utf-8")
    rows = sources.read_positional_sheet(spark, str(tmp_path / "in.csv"), 2)
    assert rows.columns == ["문장", "번호"]
    lexicon = spark.createDataFrame([("값이", "값/NNG+이/J_", "NNG"), ("싸다", "싸/VA+다/EF", "VA")], "word string, piece string, token_type string")
    listed = jobs.topic_lists(rows.fillna(""), lexicon, ["번호"], "문장")
    assert {r["번호"]: r.topics for r in listed.collect()} == {"1": ["값", "싸다"], "2": []}
    out = str(tmp_path / "wide")
    sinks.write_topic_columns(listed, out)
    wide = spark.read.option("header", True).csv(out).orderBy("번호").collect()
    assert wide[0].asDict() == {"문장": "값이 싸다", "번호": "1", "topic_1": "값", "topic_2": "싸다"}
    assert wide_topics(listed, "topics", 1).columns == ["문장", "번호", "topic_1"]


def test_tree(spark, tmp_path):
    for folder in ("x", "x/y", "z"):
        os.makedirs(tmp_path / folder, exist_ok=True)
        (tmp_path / folder / "f.csv").write_text(f"{folder}\n")
    rows = sources.read_tree(spark, str(tmp_path), "value string").collect()
    assert sorted(r.value for r in rows) == ["x", "x/y", "z"]
    assert all(r.file_path.endswith(f"/{r.value}/f.csv") for r in rows)
    assert sources.read_tree(spark, str(tmp_path / "z" / "f.csv"), "value string").count() == 1


def test_delimited_rows_survive_their_delimiter(spark, tmp_path):
    rows = spark.createDataFrame([("a;b", None), ('q"', "x")], "a string, b string")
    sinks.write_delimited(rows, str(tmp_path / "out"), sep=";")
    back = spark.read.options(sep=";", escape='"').csv(str(tmp_path / "out")).collect()
    assert sorted(tuple(r) for r in back) == [("a;b", None), ('q"', "x")]


def test_lines_append(spark, tmp_path):
    line = spark.createDataFrame([("x",)], "line string")
    sinks.write_lines(line, str(tmp_path / "corpus"))
    sinks.write_lines(line, str(tmp_path / "corpus"), append=True)
    assert spark.read.text(str(tmp_path / "corpus")).count() == 2


def test_tagged_record(spark):
    row = spark.range(1).select(tagged_record(F.lit("d_0"), "20170327", F.lit("글"), [F.lit("a"), F.lit(None), F.lit("c")])).first()[0]
    assert row == "<DOCID>d_0<DATE>20170327<CONTENT>글a\t\tc"


def test_legacy_lines_lose_nothing(spark, tmp_path):
    lines = ["가", "", "나\u0001다", " 앞뒤 ", '"따옴표', "끝"]
    (tmp_path / "in.txt").write_bytes("\r\n".join(lines).encode("cp949"))
    rows = sources.read_legacy_lines(spark, str(tmp_path / "in.txt"))
    assert [r.value for r in rows.collect()] == lines


def test_the_plan_does_not_grow_with_sheets_and_headers(spark, tmp_path):
    for i in range(6):
        order = list(sources.SURVEY_COLUMNS) if i % 2 else list(reversed(sources.SURVEY_COLUMNS))
        row = [f'"{c}\n{i}"' for c in order]
        (tmp_path / f"{i}.csv").write_text(",".join(order) + "\n" + ",".join(row) + "\n", encoding="utf-8")
    found = sources.read_survey_sheets(spark, [str(tmp_path / f"{i}.csv") for i in range(6)])
    assert sorted(r.comment for r in found.collect()) == [f"comment\n{i}" for i in range(6)]
    reads = lambda rows: rows._jdf.queryExecution().optimizedPlan().toString().count("Relation")
    assert reads(found) == reads(sources.read_survey_sheets(spark, [str(tmp_path / "0.csv")]))


def test_broken_xml_records_are_kept_apart(spark, tmp_path):
    records = ["<Doc><DocId>1</DocId><Content>a & b</Content></Doc>", "<Doc><DocId>2</DocId><Content>b</Content></Doc>"]
    (tmp_path / "in.xml").write_text("\n".join(records), encoding="utf-8")
    path = str(tmp_path / "in.xml")
    assert [r.DocId for r in sources.read_rootless_xml(spark, path).collect()] == ["2"]
    assert [r.broken for r in sources.quarantined_xml(spark, path).collect()] == ["<Doc><DocId>1</DocId><Content>a & b</Content>"]


def test_whole_texts_survive_a_legacy_charset(spark, tmp_path):
    texts = ["가나 abc", "é\\x\n\r\t|", "日本😀", "", "\\0001F600", "뷁똠 ~!\x00"]
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    sources.write_legacy_lines(rows.select(sources.legacy_text(F.col("t")).alias("value")).where("value <> ''"), path)
    got = [r[0] for r in sources.read_legacy_lines(spark, path).select(sources.restored_text(F.col("value"))).collect()]
    assert sorted(got) == sorted(t for t in texts if t)
    both = rows.select("t", sources.restored_text(sources.legacy_text(F.col("t"))).alias("u")).collect()
    assert all(r.t == r.u for r in both)


def test_records_are_taken_in_with_counts_and_quarantine(spark, tmp_path):
    body = lambda result: f'"result":{result}'
    good = [f"<Doc><DocId>{i}</DocId><Content>c{i}</Content><JSON>{j}</JSON></Doc>" for i, j in enumerate([body('[{"kma":"a"}]'), body("[]"), body('[{"kma":'), body('[{"kma":"b"}]')])]
    (tmp_path / "in.xml").write_text("\n".join([*good, "<Doc><DocId>9</Content></Doc>"]), encoding="utf-8")
    taken = ingest.ingest_records(spark, str(tmp_path / "in.xml"), str(tmp_path / "out"))
    assert taken.counts == {"ok": 2, "no_result": 1, "undecodable": 1, "broken": 1}
    assert sorted((r.doc_id, r.content, r.state) for r in taken.records.collect()) == [
        ("0", "c0", "ok"), ("1", "c1", "no_result"), ("2", "c2", "undecodable"), ("3", "c3", "ok"),
    ]
    raw = {r.state: r.raw for r in taken.quarantine.collect()}
    assert raw["undecodable"] == '{"result":[{"kma":}' and "<DocId>9" in raw["broken"] and len(raw) == 2
    plan = taken.records.where("state = 'ok'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(state" in plan
