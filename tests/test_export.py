import csv
import glob
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from docweave.operators import matching, paging, requests
from docweave.plans import export
from docweave.scratch import fresh_path
from docweave.sinks import files as sinks
from docweave.sinks.commits import StatusLog, publish_once
from docweave.sources.tables import DOCUMENT_COLUMNS, QUEUE_SCHEMA, RULE_SCHEMA, read_documents, write_documents

DOC_SCHEMA = "doc_id string, doc_datetime timestamp_ntz, doc_url string, doc_title string, doc_content string, depth1_seq int, depth2_seq int"
DOCS = [
    ("1", "2024-01-01", "http://a.com/x", "신라면 후기", "농심 신라면 맛있다", 2, 11),
    ("2", "2024-01-02", "http://b.com/ad", "라면", "농심 nongshim 신라면", 3, 15),
    ("3", "2024-02-01", None, "신라면 광고", "농심 nongshim", 2, 12),
    ("4", "2024-03-01", "http://a.com/y", "점심", "신라면 이벤트 농심 nongshim", 2, 11),
    ("5", "2024-03-02", "http://c.com", "x", "신라면들 농심 nongshim", 9, 11),
]
RULES = [
    (1, 6, "Y", "신라면", "농심,nongshim", "광고", "이벤트", "b.com/ad"),
    (2, 6, "Y", "신라면 맛있다", "", "", "", ""),
    (3, 6, "Y", "후기", "", "", "", ""),
    (4, 6, "N", "신라면들", "", "", "", ""),
    (5, 7, "Y", "농심", "", "", "", ","),
]
REQUEST = "seq int, dataset_seq int, channel string, start_date string, end_date string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(DOCS, DOC_SCHEMA.replace("timestamp_ntz", "string"))
    return rows.withColumn("doc_datetime", F.col("doc_datetime").cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame(RULES, RULE_SCHEMA)


@pytest.mark.parametrize(
    ("channel", "ids"),
    [("2^11;3^15", "124"), ("2^11,12", "134"), ("all", "12345"), ("", "12345"), (None, "12345"), ("8^1", "")],
)
def test_channels(docs, channel, ids):
    assert sorted(r.doc_id for r in matching.in_channels(docs, channel).collect()) == list(ids)


def test_period_is_inclusive_and_open_when_empty(docs):
    found = lambda a, b: "".join(sorted(r.doc_id for r in matching.in_period(docs, a, b).collect()))
    assert found("2024-01-02 00:00:00", "2024-03-01 00:00:00") == "234"
    assert found("", "2024-01-02 00:00:00") == "12" and found(None, None) == "12345"


@pytest.mark.parametrize("max_in_plan", [4096, 0])
def test_rules(docs, rules, max_in_plan):
    got = {(r.dataset_seq, r.doc_id) for r in matching.match_datasets(docs, rules, max_in_plan).collect()}
    # Document 1 fits two rules of dataset 6 and counts once; 2, 3 and 4 are excluded by URL, title, content.
    assert got == {(6, "1"), (7, "1"), (7, "2"), (7, "3"), (7, "4"), (7, "5")}
    assert matching.match_datasets(docs, rules, max_in_plan).count() == 6


@pytest.mark.parametrize("max_in_plan", [4096, 0])
def test_requests(spark, docs, rules, max_in_plan):
    wanted = spark.createDataFrame(
        [(1, 7, "2^11", "", ""), (2, None, "9^11;3^15", None, None), (3, None, "all", "2024-02-01 00:00:00", "2024-03-01 00:00:00"), (4, 99, "", "", "")],
        REQUEST,
    )
    rows = matching.filter_documents(docs, wanted, rules, max_in_plan).collect()
    assert sorted((r.seq, r.dataset_seq, r.doc_id) for r in rows) == [
        (1, 7, "1"), (1, 7, "4"), (2, None, "2"), (2, None, "5"), (3, None, "3"), (3, None, "4"),
    ]


def test_matching_equals_brute_force(spark):
    rng = random.Random(3)
    words = list("abcdefgh")
    text = lambda n: " ".join(rng.choices(words, k=n))
    docs = [(str(i), text(2), text(6), f"u{rng.randint(0, 3)}.com", rng.randint(1, 2), rng.randint(1, 3)) for i in range(150)]
    rules = [
        (i, i % 4, "Y", text(rng.randint(1, 2)), rng.choice(["", "a", "b,c"]), rng.choice(["", "d"]), rng.choice(["", "e f", "h"]), rng.choice(["", "u1.com"]))
        for i in range(14)
    ]
    frame = spark.createDataFrame(docs, "doc_id string, doc_title string, doc_content string, doc_url string, depth1_seq int, depth2_seq int")
    frame = frame.withColumn("doc_datetime", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    has = lambda t, p: f" {p} " in f" {t} "
    terms = lambda s: [p for p in s.split(",") if p]
    want = {
        (ds, d)
        for _, ds, _, key, sub, no_title, no_content, no_url in rules
        for d, title, content, url, *_ in docs
        if all(has(title, p) or has(content, p) for p in [key, *terms(sub)])
        and not any(has(title, p) for p in terms(no_title)) and not any(has(content, p) for p in terms(no_content))
        and not any(u in url for u in terms(no_url))
    }
    for limit, in_row in ((4096, 64), (0, 64), (4096, 3), (0, 0)):
        rows = matching.match_datasets(frame, spark.createDataFrame(rules, RULE_SCHEMA), limit, in_row).collect()
        assert len(rows) == len(want) and {(r.dataset_seq, r.doc_id) for r in rows} == want


def test_more_entry_words_than_the_plan_holds(spark):
    """Thousands of rules, each with a word that most documents hold; the measured limit chooses the way."""
    rng = random.Random(11)
    docs = [(str(i), "the title", " ".join(["the", "hot", *(f"w{rng.randrange(6_000)}" for _ in range(30))])) for i in range(400)]
    docs += [("none", None, None), ("twice", "w1 the", "w2"), ("twice", "w1 the", "w2")]
    rules = [(i, i % 50, "Y", f"w{i}", "the", "", rng.choice(["", "w5 w6", f"w{rng.randrange(6_000)}"]), "") for i in range(5_000)]
    frame = spark.createDataFrame([(*d, None, 1, 2) for d in docs], "doc_id string, doc_title string, doc_content string, doc_url string, depth1_seq int, depth2_seq int")
    frame = frame.withColumn("doc_datetime", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    held = [(i, set(f"{t or ''} {c or ''}".split()), f" {c or ''} ") for i, t, c in docs]
    want = sorted(
        (ds, doc_id) for doc_id, words, content in held for ds in range(50)
        if any(key in words and "the" in words and not (no and f" {no} " in content) for _, own, _, key, _, _, no, _ in rules if own == ds)
    )
    table = spark.createDataFrame(rules, RULE_SCHEMA)
    rows = matching.match_datasets(frame, table).collect()
    assert sorted((r.dataset_seq, r.doc_id) for r in rows) == want and len(want) > 3_000
    decided = matching.rule_decisions(frame, table, ["doc_id"]).where("rule_id < 40").select("doc_id", "rule_id").collect()
    assert sorted(tuple(r) for r in decided) == sorted((i, rule[0]) for i, words, _ in held for rule in rules[:40] if {rule[3], "the"} <= words)


def test_rules_are_entered_by_their_rarest_word(spark):
    docs = spark.createDataFrame([(["veryfrequentword", "hot", f"w{i}"],) for i in range(500)], "keys array<string>")
    sketch = matching.word_sketch(docs)
    assert sketch.count() <= matching.SKETCH_LINES * matching.SKETCH_CELLS
    words = spark.createDataFrame([("hot",), ("w7",), ("unseen",)], "word string")
    counts = {r.word: r.n for r in matching.sketched_counts(words, sketch).collect()}
    assert counts["hot"] >= 500 and 1 <= counts["w7"] < 20 and counts["unseen"] < 20
    rules = spark.createDataFrame([(1, 1, "Y", "veryfrequentword w7", "hot", "", "", ""), (2, 1, "Y", "unseen veryfrequentword", "", "", "", "")], RULE_SCHEMA)
    entered = matching.entered_by_rarest(matching.active_rules(rules), sketch).collect()
    assert sorted(r.entry_word for r in entered) == ["unseen", "w7"]


def test_a_text_is_held_against_the_rules_of_its_words_alone(spark, monkeypatch):
    """With many entry words, no target carries rules that another word enters; pairs found at several words count once."""
    docs = spark.createDataFrame([(str(i), f"apple{i % 7} pear{i % 5}", "fig") for i in range(70)], "doc_id string, doc_title string, doc_content string")
    docs = docs.withColumns({"doc_url": F.lit(""), "doc_datetime": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "depth1_seq": F.lit(1), "depth2_seq": F.lit(1)})
    listed = [(1, "Y", f"{fruit}{i}", "fig", "", "", "") for fruit, n in (("apple", 6), ("pear", 4)) for i in range(n)]
    rules = spark.createDataFrame(listed, "dataset_seq int, use_yn string, keyword string, sub_keywords string, title_filter_keywords string, content_filter_keywords string, filter_urls string")
    tables, written = {}, matching.written_table
    monkeypatch.setattr(matching, "written_table", lambda df, name, *args: tables.setdefault(name, []).append(written(df, name, *args)) or tables[name][-1])
    got = [r.doc_id for r in matching.match_datasets(docs, rules, max_in_plan=2).collect()]
    assert sorted(got) == sorted(str(i) for i in range(70) if i % 7 < 6 or i % 5 < 4)
    assert tables["targets"][-1].agg(F.max(F.size("rules"))).first()[0] == 1


@pytest.mark.parametrize("max_in_plan", [4096, 0])
def test_requests_without_rules_by_period_and_channel(spark, max_in_plan):
    """Short and long periods, channels with missing parts: the same as testing every pair."""
    rng = random.Random(6)
    moment = lambda: f"{rng.randint(2015, 2026)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02} 0{rng.randint(0, 9)}:00:00"
    docs = [(str(i), moment(), rng.choice([1, 2, None]), rng.choice([1, 2, 3, None])) for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id string, doc_datetime string, depth1_seq int, depth2_seq int")
    frame = frame.withColumns({"doc_datetime": F.col("doc_datetime").cast("timestamp_ntz"), **{c: F.lit(None).cast("string") for c in ("doc_title", "doc_content", "doc_url")}})
    channels = {"all": None, "": None, "1^1,2;2^3": {(1, 1), (1, 2), (2, 3)}, "2^": {(2, None)}, "9^9": {(9, 9)}}
    asked = [(i, None, rng.choice(list(channels)), *sorted([moment(), moment()])) for i in range(20)] + [(90, None, "1^1", "", ""), (91, None, "all", "2026-01-01 00:00:00", "2020-01-01 00:00:00")]
    rows = matching.filter_documents(frame, spark.createDataFrame(asked, REQUEST), max_in_plan=max_in_plan).collect()
    want = [
        (seq, doc_id) for seq, _, channel, start, end in asked for doc_id, at, d1, d2 in docs
        if (start or "1900") <= at <= (end or "2100") and (channels.get(channel, {(1, 1)}) is None or (d1, d2) in channels.get(channel, {(1, 1)}))
    ]
    assert sorted((r.seq, r.doc_id) for r in rows) == sorted(want) and len(want) > 300


def test_positions_with_one_hot_group(spark):
    rng = random.Random(5)
    rows = [(1 if rng.random() < 0.7 else rng.choice([2, 3, None]), rng.randint(0, 40), f"{i:05d}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "g int, t int, id string").repartition(7)
    got = paging.add_positions(frame, ["g"], ["t", "id"]).collect()
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0], []).append(row[2])
    assert len(got) == len(rows)
    assert {(r.g, r.id): r.position for r in got} == {(g, i): n for g, ids in groups.items() for n, i in enumerate(ids)}


@pytest.mark.parametrize(("n", "sizes"), [(0, []), (9, [9]), (10, [10]), (11, [10, 1]), (25, [10, 10, 5])])
def test_pages_and_manifest(spark, n, sizes):
    matched = spark.range(n).select(F.lit(1).alias("seq"), F.lit(6).alias("dataset_seq"), F.lit(0).alias("doc_datetime"), F.col("id").alias("doc_id"))
    paged = paging.add_pages(matched, 10).collect()
    counts = [sum(r.page == p for r in paged) for p in range(len(sizes))]
    assert counts == sizes and len(paged) == n and all(r.row_no < 10 for r in paged)
    named = spark.createDataFrame([(1, 6, "20240101/1", "f")], "seq int, dataset_seq int, directory string, file_name string")
    listed = paging.manifest(named, matched, 10).orderBy("page").collect()
    assert [r.n_rows for r in listed] == (sizes or [0])
    assert [r.file_name for r in listed] == ([f"f{'' if p == 0 else f'({p})'}" for p in range(len(sizes))] or [None])


QUEUE = [
    (12, 1, "T1", 1, "2017-06-01 09:00:00", "6,7", "all", "2024-01-01 00:00:00", "2024-12-31 23:59:59", "N", None, "I"),
    (13, 1, "T1", 1, "2017-06-02 09:00:00", None, "2^11", None, None, "N", None, "I"),
    (14, 2, "T1", 1, "2017-06-02 09:00:00", "6", "all", None, None, "N", None, "I"),
    (15, 1, "T1", 1, "2017-06-02 09:00:00", "6", "all", None, None, "N", None, "C"),
]


@pytest.fixture(scope="module")
def control(spark, rules):
    queue = spark.createDataFrame(QUEUE, QUEUE_SCHEMA.replace("timestamp_ntz", "string"))
    stamps = {c: F.col(c).cast("timestamp_ntz") for c in ("reg_dt", "start_date", "end_date")}
    users = spark.createDataFrame([(1, "Y"), (2, "N")], "seq int, use_yn string")
    codes = spark.createDataFrame([("T1", "소셜모니터링"), ("T1", "중복")], "type_cd string, name string")
    return export.ControlTables(queue.withColumns(stamps), users, codes, rules)


def test_file_names(control):
    rows = {(r.seq, r.dataset_seq): r for r in export.named_requests(control).collect()}
    assert set(rows) == {(12, 6), (12, 7), (13, None)}
    assert rows[12, 6].directory == "20170601/12"
    assert rows[12, 6].file_name == "12_소셜모니터링_전채널_20240101_20241231_6"
    assert rows[13, None].file_name == "13_소셜모니터링_채널일부"


def test_swap_extension(spark):
    got = spark.createDataFrame([("/a/b.c/in.xml",), ("/a/x",)], "p string").select(requests.swap_extension("p", ".SCD")).collect()
    assert [r[0] for r in got] == ["/a/b.c/in.SCD", "/a/x"]


def with_all_columns(docs):
    return docs.withColumns({c: F.lit("v").alias(c) for c in DOCUMENT_COLUMNS if c not in docs.columns})


@pytest.fixture
def shared(spark):
    """A base folder and a status log for the runs of a test."""
    return fresh_path(spark, "export"), fresh_path(spark, "status")


def statuses(spark, log):
    return {r.seq: r.status for r in requests.current_status(StatusLog(spark, log).events()).collect()}


def live(spark, shared):
    """Rows of the live pages by request and file name."""
    out = {}
    for row in export.live_pages(spark, *shared).collect():
        out.setdefault((int(row.seq), row.file_name), []).append(row.doc_id)
    return {name: sorted(ids) for name, ids in out.items()}


def test_export_writes_pages_manifest_and_statuses(spark, docs, control, shared):
    base, log = shared
    listed = export.run_export(with_all_columns(docs), control, base, log, size=2, run_id="one").collect()
    assert {(r.seq, r.dataset_seq, r.page, r.n_rows) for r in listed} == {
        (12, 6, 0, 1), (12, 7, 0, 2), (12, 7, 1, 2), (12, 7, 2, 1), (13, None, 0, 2),
    }
    local = base.removeprefix("file:")
    for row in listed:
        reg_dt, seq = row.directory.split("/")
        found = glob.glob(f"{glob.escape(f'{local}/pages/run=one/reg_dt={reg_dt}/seq={seq}/file_name={row.file_name}')}/*.csv")
        assert len(found) == 1
        with open(found[0], encoding="utf-8") as file:
            lines = list(csv.reader(file))
        assert lines[0] == DOCUMENT_COLUMNS and len(lines) == row.n_rows + 1
    after = requests.with_current_status(control.queue, StatusLog(spark, log).events())
    assert {r.seq: r.status for r in after.collect()} == {12: "C", 13: "C", 14: "I", 15: "C"}
    assert {r.status for r in StatusLog(spark, log).events().where("seq = 12").collect()} == {"P", "C"}
    assert {len(ids) for ids in live(spark, shared).values()} == {1, 2} and len(live(spark, shared)) == 5


def test_runs_share_a_base_and_done_requests_are_left_out(spark, docs, control, shared):
    base, log = shared
    first = export.run_export(with_all_columns(docs), control, base, log, size=2).count()
    pages = live(spark, shared)
    assert first == 5 and export.run_export(with_all_columns(docs), control, base, log, size=2).count() == 0
    again = StatusLog(spark, log)
    assert again.append(spark.createDataFrame([(12,)], "seq bigint"), requests.PENDING, again.version())
    assert statuses(spark, log) == {12: "I", 13: "C"}
    assert {r.seq for r in export.run_export(with_all_columns(docs), control, base, log, size=2).collect()} == {12}
    assert statuses(spark, log) == {12: "C", 13: "C"} and live(spark, shared) == pages


def test_a_shorter_export_leaves_no_pages_of_the_longer_one(spark, docs, control, shared):
    base, log = shared
    export.run_export(with_all_columns(docs), control, base, log, size=2)
    before = live(spark, shared)
    again = StatusLog(spark, log)
    again.append(spark.createDataFrame([(12,)], "seq bigint"), requests.PENDING, again.version())
    gone = max((ids for (seq, _), ids in before.items() if seq == 12), key=len)
    export.run_export(with_all_columns(docs.where(~F.col("doc_id").isin(gone))), control, base, log, size=2)
    after = live(spark, shared)
    assert {n for n in before if n[0] == 12} > {n for n in after if n[0] == 12}
    assert not any(set(gone) & set(ids) for (seq, _), ids in after.items() if seq == 12)
    assert {n: ids for n, ids in before.items() if n[0] == 13} == {n: ids for n, ids in after.items() if n[0] == 13}
    listed = export.live_manifest(spark, base, log).where("page IS NOT NULL").collect()
    assert {(r.seq, r.file_name): r.n_rows for r in listed} == {n: len(ids) for n, ids in after.items()}


HOUR = timedelta(hours=1)
NOON = datetime(2024, 6, 1, 12, tzinfo=timezone.utc)


@pytest.mark.parametrize("step", ["filter_documents", "write_pages", "manifest", "finish"])
def test_a_failed_run_is_taken_up_after_its_lease(spark, docs, control, shared, monkeypatch, step):
    """Whatever step fails, nothing of the run is live, and its requests are free when its lease has ended."""
    base, log = shared
    owner = {"filter_documents": export.matching, "manifest": export.paging}.get(step, export)

    def fail(*_, **__):
        raise RuntimeError(step)

    run = lambda now: export.run_export(with_all_columns(docs), control, base, log, size=2, lease=HOUR, now=now)
    with monkeypatch.context() as patch:
        patch.setattr(owner, step, fail)
        with pytest.raises(RuntimeError):
            run(NOON)
    assert set(statuses(spark, log).values()) == {"P"}
    assert requests.finished_runs(StatusLog(spark, log).events()).isEmpty()
    assert run(NOON + HOUR / 2).count() == 0
    assert run(NOON + 2 * HOUR).count() == 5 and len(live(spark, shared)) == 5
    assert set(statuses(spark, log).values()) == {"C"}


def test_interleaved_runs_export_each_request_once(spark, docs, control, shared, monkeypatch):
    """The second run does all its work between the reading and the claim of the first."""
    base, log = shared
    run = lambda run_id: export.run_export(with_all_columns(docs), control, base, log, size=2, run_id=run_id)
    append, between = StatusLog.append, []

    def claim(self, rows, status, after, run_id=None, expires=None):
        if run_id == "first" and not between:
            between.append(None)
            between[0] = run("second").collect()
        return append(self, rows, status, after, run_id, expires)

    monkeypatch.setattr(StatusLog, "append", claim)
    assert run("first").count() == 0 and {r.seq for r in between[0]} == {12, 13}
    events = StatusLog(spark, log).events().collect()
    assert sorted((r.seq, r.status, r.run_id) for r in events) == [(s, t, "second") for s in (12, 13) for t in "CP"]


def test_a_run_that_lost_its_lease_finishes_nothing(spark, docs, control, shared, monkeypatch):
    base, log = shared
    run = lambda run_id, now: export.run_export(with_all_columns(docs), control, base, log, size=2, run_id=run_id, lease=HOUR, now=now)
    finish, between = export.finish, []

    def late(own_log, run_id):
        if run_id == "slow":
            between.append(run("other", NOON + 2 * HOUR).count())
        return finish(own_log, run_id)

    monkeypatch.setattr(export, "finish", late)
    assert run("slow", NOON).count() == 0 and between == [5]
    assert {r.run for r in export.live_manifest(spark, base, log).collect()} == {"other"} and len(live(spark, shared)) == 5


def test_one_of_several_writers_wins(spark):
    path = fresh_path(spark, "commit") + "/1"
    assert publish_once(spark, path, "a") and not publish_once(spark, path, "b")
    assert [r.value for r in spark.read.text(path).collect()] == ["a"]


def test_rows_with_null_and_repeated_ids_count_on_both_ways(spark, docs, rules):
    twice = docs.unionByName(docs.where("doc_id = '1'")).unionByName(docs.where("doc_id = '5'").withColumn("doc_id", F.lit(None).cast("string")))
    rows = [
        sorted((r.dataset_seq, str(r.doc_id)) for r in matching.match_datasets(twice, rules, limit, in_row).collect())
        for limit, in_row in ((4096, 64), (0, 64), (4096, 0), (0, 0))
    ]
    assert rows[0] == rows[1] == rows[2] == rows[3] and rows[0].count((7, "1")) == 2 and (7, "None") in rows[0]


def test_bounds_of_the_requests_reach_the_scan(spark, docs):
    path = fresh_path(spark, "docs")
    docs.write.parquet(path)
    wanted = spark.createDataFrame([(1, None, "2^11", "2024-01-02 00:00:00", "2024-03-01 00:00:00"), (2, None, "2^12", "2024-01-01 00:00:00", "2024-02-01 00:00:00")], REQUEST)
    found = matching.filter_documents(spark.read.parquet(path), wanted)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = text[text.index("PushedFilters") :]
    assert "GreaterThanOrEqual(doc_datetime" in pushed and ("In(depth1_seq" in pushed or "EqualTo(depth1_seq" in pushed)
    assert sorted((r.seq, r.doc_id) for r in found.collect()) == [(1, "4"), (2, "3")]


def test_unordered_pages(spark, docs):
    path = fresh_path(spark, "unordered")
    matched = docs.select(F.lit(1).alias("seq"), F.lit(6).alias("dataset_seq"), "doc_id").repartition(1)
    sinks.write_pages_unordered(matched, path, 2, ["doc_id"])
    assert len(glob.glob(f"{path.removeprefix('file:')}/seq=1/dataset_seq=6/*.csv")) == 3


def test_filters_reach_the_scan(spark, docs):
    path = fresh_path(spark, "docs")
    docs.write.parquet(path)
    stored = spark.read.parquet(path)
    plan = matching.in_channels(matching.in_period(stored, "2024-01-02 00:00:00", ""), "2^11").select("doc_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    pushed = text[text.index("PushedFilters") :]
    assert "GreaterThanOrEqual(doc_datetime" in pushed
    assert "doc_content" not in text[text.index("ReadSchema") :]


def test_stored_documents_are_read_by_month_and_channel(spark, docs, control, shared):
    path = fresh_path(spark, "stored")
    write_documents(with_all_columns(docs), path)
    stored = read_documents(spark, path)
    wanted = spark.createDataFrame([(1, None, "2^11", "2024-01-02 00:00:00", "2024-01-31 00:00:00"), (2, None, "9^11", "2024-03-01 00:00:00", "2024-03-31 00:00:00")], REQUEST)
    found = matching.filter_documents(stored, wanted)
    plan = found._jdf.queryExecution().optimizedPlan().toString() + found._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "stored_month" in filters and "stored_channel" in filters
    assert sorted((r.seq, r.doc_id) for r in found.collect()) == [(2, "5")]
    base, log = shared
    listed = export.run_export(stored, control, base, log, size=2)
    assert listed.count() == 5 and set(export.live_pages(spark, base, log).columns) >= set(DOCUMENT_COLUMNS)
