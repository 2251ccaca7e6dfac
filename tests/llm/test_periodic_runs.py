import hashlib
import random
from fractions import Fraction
from zlib import crc32

import pytest

from docweave.llm.periodic_runs import best_run, collapsed, find_runs, periodic_runs
from docweave.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def brute_runs(words):
    """Every stretch with its smallest period, by trying all periods at all places."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            piece = words[start : i + q]
            if len(piece) >= max(6, 4 * q) and not any(piece[p:] == piece[:-p] for p in range(1, q)):
                out.append((start, len(piece), q))
    return sorted(out, key=lambda run: (run[0], run[2]))


def brute_row(doc_id, text, planted=True):
    words = (text or "").encode().split()
    n, h = len(words), crc32(b"" if doc_id is None else str(doc_id).encode())
    if planted and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2])) if runs else (None,) * 3
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    kept = b" ".join(word for i, word in enumerate(words) if i not in gone)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    exponent = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, exponent, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def _random_words(rng):
    n, letters = rng.choice([0, 1, 5, 6, 7, 40, 200, 500]), rng.choice([1, 2, 3, 8, 60])
    words = [b"%d" % rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 4) if n > 8 else 0):
        start = rng.randrange(n)
        unit = words[start : start + rng.randint(1, max(1, (n - start) // rng.randint(2, 8)))]
        stop = min(n, start + rng.randint(len(unit), 6 * len(unit)))
        words[start:stop] = [unit[i % len(unit)] for i in range(stop - start)]
    return words


def test_runs_are_those_of_brute_force():
    rng = random.Random(3)
    n_runs = 0
    for _ in range(240):
        texts = [_random_words(rng) for _ in range(rng.randint(1, 5))]
        want = [brute_runs(words) for words in texts]
        assert find_runs(texts) == want
        n_runs += sum(map(len, want))
    assert n_runs > 300


@pytest.mark.parametrize("period", [1, 8, 9, 16, 17, 31, 32, 33, 100, 1_000])
def test_periods_around_each_scale(period):
    unit = [b"w%d" % i for i in range(period)]
    for length in (max(6, 4 * period) - 1, max(6, 4 * period), 7 * period + 3):
        words = [b"x", *(unit[i % period] for i in range(length)), b"y", b"z"]
        want = [(1, length, period)] if length >= max(6, 4 * period) else []
        assert find_runs([words]) == [want]


def test_nested_and_touching_runs():
    inner = [b"a"] * 9 + [b"b"]
    words = inner * 5 + [b"c"] * 6
    assert find_runs([words]) == [brute_runs(words)]
    runs = find_runs([words])[0]
    assert (0, 50, 10) in runs and (0, 9, 1) in runs
    assert best_run(runs) == (0, 9, 1)
    assert collapsed(words, runs) == [b"a", b"b", b"c"]


def test_best_run_takes_the_first_of_equals():
    assert best_run([]) is None
    assert best_run([(0, 8, 2), (3, 12, 3), (20, 16, 4)]) == (0, 8, 2)
    assert best_run([(0, 8, 2), (3, 13, 3)]) == (3, 13, 3)


def test_odd_rows(odd, odd_rows):
    got = sorted((tuple(row) for row in periodic_runs(odd).collect()), key=str)
    short = [row for row in odd_rows if len(row[1] or "") < 10_000]
    want = sorted((brute_row(*row, planted=False) for row in short), key=str)
    assert [row for row in got if row[0] not in (5, 6)] == want
    assert sum(row[0] in (5, 6) for row in got) == 2


def test_a_long_text_of_one_word_and_all_runs(make_docs):
    row = periodic_runs(make_docs(["same " * 50_000]), with_runs=True).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (1, 0, 50_000, 1, 50_000_000)
    assert row.collapsed == "same" and [tuple(run) for run in row.runs] == [(0, 50_000, 1)]


def test_empty_table(empty):
    assert periodic_runs(empty).collect() == []


def test_query_is_that_of_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = {row.doc_id: tuple(row) for row in QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()}
    short = [row for row in rows if len(row.text or "") < 20_000]
    assert len(got) == len(rows) and len(short) > 150
    assert all(got[row.doc_id] == brute_row(row.doc_id, row.text) for row in short)
