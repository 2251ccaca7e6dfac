import random

from pyspark.sql import functions as F

from docweave.functions.text import TOKEN
from docweave.operators import lookup


def brute_best(text, entries):
    import re

    tokens = lambda t: set(re.findall(r"[^\W_]+", t.lower()))
    scored = [(-len(tokens(text) & tokens(verb)), verb, emotion) for verb, emotion in entries if tokens(text) & tokens(verb)]
    return min(scored)[2] if scored else ""


def test_best_match_equals_brute_force_on_both_ways(spark):
    assert TOKEN == r"[\p{L}\p{N}]+"
    rng = random.Random(7)
    words = ["좋다", "싸다", "비싸다", "느리다", "a", "b", "c"]
    entries = sorted({(" ".join(rng.sample(words, rng.randint(1, 3))), rng.choice(["긍정", "부정", ""])) for _ in range(25)})
    texts = [" ".join(rng.choices([*words, "x", "y"], k=rng.randint(0, 5))) for _ in range(120)]
    dictionary = lookup.emotion_dictionary(spark.createDataFrame(entries, "verb string, emotion string"))
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for limit, hot in ((4096, 1000), (0, 1000), (0, 6), (0, 0)):
        got = lookup.best_match(rows, F.col("t"), dictionary, "e", limit, hot).orderBy("i").collect()
        assert [r.e for r in got] == [brute_best(t, entries) for t in texts]


def test_exact_lookup_takes_the_first_entry(spark):
    category = spark.createDataFrame(
        [("b", "값", "요금", "2"), ("a", "가격", "값", "1"), ("", "", "", "9")],
        "category_eng string, category_kor string, synonym string, subtopic_code string",
    )
    rows = spark.createDataFrame([("값",), ("요금",), ("",), (None,)], "t string")
    for limit in (None, 0):
        got = lookup.exact_lookup(rows, F.col("t"), lookup.category_dictionary(category), "c", limit).collect()
        assert {r.t: r.c for r in got} == {"값": "1", "요금": "2", "": "", None: ""}


def test_rows_of_one_key_count_together_on_both_ways(spark):
    entries = [("z", "first", "", "a"), ("z", "first", "", "b"), ("m", "second", "", "a x")]
    category = spark.createDataFrame(
        [(key, kor, words, code) for key, code, kor, words in entries], "category_eng string, category_kor string, synonym string, subtopic_code string"
    )
    rows = spark.createDataFrame([("a b",), ("a",), (None,)], "t string")
    for limit, hot in ((4096, 1000), (0, 1000), (0, 0)):
        got = lookup.best_match(rows, F.col("t"), lookup.category_dictionary(category), "c", limit, hot).collect()
        assert {r.t: r.c for r in got} == {"a b": "first", "a": "second", None: ""}


def test_entries_of_many_rows_equal_brute_force(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(30)]
    keys = [(None, "none"), ("a", "1"), ("a", "2"), ("b", None), ("c", "3"), ("d", "4")]
    rows = [(*rng.choice(keys), " ".join(rng.sample(words, rng.randint(0, 3)))) for _ in range(40)]
    texts = [" ".join(rng.choices([*words, "x"], k=rng.randint(0, 6))) for _ in range(80)]
    dictionary = spark.createDataFrame(rows, "key string, value string, words string").withColumn("terms", F.array())
    gathered: dict = {}
    for key, value, text in rows:
        gathered.setdefault((key, value), set()).update(text.split())
    order = lambda x: (x is not None, x or "")

    def brute(text):
        scored = [(-n, order(k), order(v), v) for (k, v), own in gathered.items() if (n := len(own & set(text.split())))]
        return (min(scored)[3] or "") if scored else ""

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for hot in (1000, 3, 2, 0):
        got = lookup.best_match(docs, F.col("t"), dictionary, "e", 0, hot).orderBy("i").collect()
        assert [r.e for r in got] == [brute(t) for t in texts], hot


def test_an_entry_with_a_large_vocabulary_costs_in_proportion(spark):
    import time

    n = 20_000
    words = F.concat(F.lit("w"), F.col("id").cast("string"))
    dictionary = spark.range(n).select(F.lit("k").alias("key"), F.lit("v").alias("value"), F.array().alias("terms"), words.alias("words"))
    texts = spark.createDataFrame([("w1 w19999",), ("x",)], "t string")
    start = time.perf_counter()
    assert {r.t: r.e for r in lookup.best_match(texts, F.col("t"), dictionary, "e").collect()} == {"w1 w19999": "v", "x": ""}
    assert time.perf_counter() - start < 20


def test_large_literals_cost_what_small_ones_cost(spark):
    import time

    from docweave.functions.dictionary import lookup as literal

    def seconds(n):
        entries = {f"w{i}": f"v{i}" for i in range(n)}
        key = F.concat(F.lit("w"), (F.col("id") % n).cast("string"))
        found = spark.range(400_000).select(literal(key, entries, "string", F.lit("")).alias("v"))
        assert found.where("v = ''").isEmpty()
        start = time.perf_counter()
        found.agg(F.max("v")).collect()
        return time.perf_counter() - start

    seconds(20)
    assert seconds(4_000) < 4 * seconds(20) + 1


def test_a_search_lists_few_entries_of_frequent_tokens(spark, monkeypatch):
    """Texts hold tokens of thousands of entries and a rare pair: rows after the explode stay near the rare lists."""
    n_entries, n_texts, n_hot = 3_000, 200, 6
    hot = [f"hot{i}" for i in range(n_hot)]
    entries = [(f"k{i:05}", f"v{i}", " ".join([f"rare{i % 1500}", f"also{i % 1500}", *hot[: i % n_hot]])) for i in range(n_entries)]
    texts = [(i, " ".join([f"rare{i}", f"also{i}", "unknown", hot[0]])) for i in range(n_texts)]
    dictionary = spark.createDataFrame(entries, "key string, value string, words string")
    listed, hits = [], lookup._hits

    def counted(asked, postings):
        found = hits(asked, postings)
        listed.append(found.count())
        return found

    monkeypatch.setattr(lookup, "_hits", counted)
    rows = lookup.best_match(spark.createDataFrame(texts, "i int, t string"), F.col("t"), dictionary, "e", 0).collect()
    own = {key: (value, set(words.split())) for key, value, words in entries}
    for row in rows[::20]:
        assert row.e == min((-len(words & set(row.t.split())), key, value) for key, (value, words) in own.items())[2]
    full = sum(len([1 for _, words in own.values() if token in words]) for _, text in texts for token in text.split())
    assert sum(listed) <= 2 * 2 * n_texts + n_entries and full > 400_000


def test_a_dictionary_is_computed_once(spark):
    """The words of a large dictionary pass through the plan that makes them a single time."""
    seen = spark.sparkContext.accumulator(0)

    def made(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    verbs = spark.range(6_000).selectExpr("concat('w', id) AS verb", "'e' AS emotion").mapInArrow(made, "verb string, emotion string")
    texts = spark.createDataFrame([("w17 x",), ("y",)], "t string")
    got = lookup.best_match(texts, F.col("t"), lookup.emotion_dictionary(verbs), "e").collect()
    assert {r.t: r.e for r in got} == {"w17 x": "e", "y": ""} and seen.value == 6_000


def test_few_entries_are_counted_as_they_are_searched(spark):
    """130 entries take three numbers of 64 bits; keys, values and texts may be null or repeated, and ties are many."""
    rng = random.Random(8)
    some = lambda n: " ".join(f"w{rng.randrange(60)}" for _ in range(n))
    entries = [(rng.choice([None, "a", *[f"k{i:03d}"] * 30]), rng.choice([None, "v", *[f"v{i}"] * 30]), some(rng.randint(0, 9))) for i in range(160)]
    dictionary = spark.createDataFrame(entries, "key string, value string, words string")
    texts = [(i, rng.choice([None, "", "other", some(3), some(12), some(40)])) for i in range(400)]
    rows = spark.createDataFrame(texts + texts[:50], "i int, t string")
    found = lambda few: lookup.best_match(rows, F.col("t"), dictionary, "e", 0, few_entries=few)
    assert dictionary.select("key", "value").distinct().count() > 64
    searched, counted = found(0), found(256)
    assert sorted(map(tuple, counted.collect()), key=str) == sorted(map(tuple, searched.collect()), key=str)
    assert len({r.e for r in counted.collect()}) > 20


def test_entries_of_long_texts_meet_a_text_once_per_token(spark):
    """What is gathered for a text are its tokens' marks, one row each, not a row for each entry of each token."""
    words = " ".join(f"w{i}" for i in range(50))
    dictionary = spark.createDataFrame([(f"k{i:02d}", f"v{i}", f"{words} own{i}") for i in range(80)], "key string, value string, words string")
    rows = spark.range(200).select(F.col("id"), F.concat(F.lit(words + " x"), "id").alias("t"))
    tables = []
    written = lookup.written_table
    lookup.written_table = lambda df, name, *args: tables.append(table := written(df, name, *args)) or table
    try:
        assert {r.e for r in lookup.best_match(rows, F.col("t"), dictionary, "e", 0).collect()} == {"v0"}
    finally:
        lookup.written_table = written
    assert max(table.count() for table in tables) <= 200
