import hashlib
import random

import pytest
from pyspark.sql import functions as F

from docweave.llm import near_dedup as near
from docweave.llm.components import components
from docweave.llm.exact_dedup import drop_copies, exact_dedup
from docweave.llm.near_dedup import drop_near_copies, near_dedup, shingle_set
from docweave.llm.substring_dedup import substring_dedup


@pytest.mark.parametrize("digest", [None, lambda text: F.pmod(F.crc32(text.cast("binary")), F.lit(3))])
def test_equal_texts_are_groups_even_if_digests_collide(odd, odd_rows, digest):
    got = exact_dedup(odd, digest=digest).collect()
    texts = {}
    for doc_id, text in odd_rows:
        texts.setdefault(text or "", []).append(doc_id)
    largest = lambda ids: max((i for i in ids if i is not None), default=None)
    want = sorted(
        (str(i), str(largest(ids)), len(ids), hashlib.sha256(text.encode()).hexdigest()) for text, ids in texts.items() for i in ids
    )
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(texts)


def test_one_row_of_each_text_stays(odd, odd_rows, empty):
    left = drop_copies(odd)
    assert left.columns == odd.columns and left.count() == len({text or "" for _, text in odd_rows})
    assert exact_dedup(empty).count() == 0 and drop_copies(empty).count() == 0


def brute_components(texts, width):
    sets = [shingle_set(text or "", width) for text in texts]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return [root(i) for i in range(len(sets))]


def varied_copies(r, n_groups, copies, words=60):
    texts = []
    for _ in range(n_groups):
        base = [f"w{r.randint(0, 4_000)}" for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3, 5])):
                text[r.randrange(words)] = f"x{r.randint(0, 9_999)}"
            texts.append(" ".join(text))
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("limits", [(512, 256, 512), (4, 3, 5)])
def test_near_copies_are_those_of_brute_force(make_docs, monkeypatch, limits):
    for name, value in zip(("HOT", "APART_BLOCK", "ALL_BLOCK"), limits):
        monkeypatch.setattr(near, name, value)
    texts = varied_copies(random.Random(5), 6, 25) + ["", "  ", "Alone", "alone", "two words", "a b a b a b", "a b"]
    rows = near_dedup(make_docs(texts).repartition(4), width=2).collect()
    got = {r.doc_id: (r.component_id, r.n_shingles, r.kept) for r in rows}
    want = {i: (c, len(shingle_set(texts[i], 2)), c == i) for i, c in enumerate(brute_components(texts, 2))}
    assert got == want


def test_only_near_texts_bring_their_sets(make_docs, monkeypatch):
    # Long texts with some lines in common: they share postings, and the upper bits of most of their coordinates are zero.
    r = random.Random(5)
    lines = " ".join(f"line{i}" for i in range(40))
    texts = [lines + " " + " ".join(f"w{r.randrange(10**9)}" for _ in range(900)) for _ in range(40)]
    seen, links, sets = [], near._first_links, near._sets
    monkeypatch.setattr(near, "_first_links", lambda pairs: seen.append(pairs.count()) or links(pairs))
    monkeypatch.setattr(near, "_sets", lambda texts, width: seen.append(texts.count()) or sets(texts, width))
    rows = near_dedup(make_docs([*texts, texts[0] + " more"]), width=2).collect()
    assert {r.doc_id for r in rows if not r.kept} == {40}
    assert seen[:2] == [2, 1]  # texts, pairs


def test_near_dedup_of_odd_rows(odd, odd_rows, empty):
    rows = near_dedup(odd, width=5).collect()
    assert len(rows) == len(odd_rows)
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5} and sum(r.stays for r in rows if r.doc_id in (5, 6)) == 1
    alike = [r for r in rows if r.n_shingles == 1 and r.component_id == 4 and r.doc_id in (4, None)]
    assert len(alike) == 3 and sum(r.stays for r in alike) == 1
    assert all(r.stays and r.component_id == r.doc_id for r in rows if r.n_shingles == 0)
    assert drop_near_copies(odd).columns == odd.columns and near_dedup(empty).count() == 0 and drop_near_copies(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(2, 60)]
    got = components(spark.createDataFrame([*chain, *star, (7, 7), (2, 1)], "a long, b long")).collect()
    want = {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 60)}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_removed(rows, window):
    """rows: (id, text) in the order that counts."""
    seen, out = set(), []
    for _, text in rows:
        words, gone = (text or "").encode().split(), set()
        for start in range(len(words) - window + 1):
            key = tuple(words[start : start + window])
            if key in seen:
                gone.update(range(start, start + window))
            seen.add(key)
        kept = b" ".join(word for i, word in enumerate(words) if i not in gone)
        out.append((len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("window, base", [(6, 3), (8, 2), (20, 5)])
def test_repeated_windows_are_those_of_brute_force(make_docs, window, base):
    r = random.Random(window * 10 + base)
    passages = [" ".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(4, 40))) for _ in range(8)]
    texts = [" ".join(r.choice([*passages, *"abcde", "\n", "\xa0"]) for _ in range(r.randint(0, 12))) for _ in range(60)]
    texts += ["z " * 50, "z " * 30, texts[3], texts[5], texts[3]]
    rows = substring_dedup(make_docs(texts).repartition(5), window, base).collect()
    want = brute_removed(list(enumerate(texts)), window)
    assert {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256) for x in rows} == dict(enumerate(want))
    assert all(sum(s.end - s.start for s in x.spans) == x.n_removed for x in rows)


def test_substring_dedup_of_odd_rows(odd, odd_rows, empty):
    rows = {(x.doc_id, x.n_words): x for x in substring_dedup(odd).collect()}
    assert rows[(6, 24_000)].n_removed == 24_000 and 0 < rows[(5, 24_000)].n_removed < 24_000
    assert rows[(1, 0)].kept_sha256 == hashlib.sha256(b"").hexdigest() and substring_dedup(odd).count() == len(odd_rows)
    assert substring_dedup(empty).count() == 0
    with pytest.raises(ValueError):
        substring_dedup(odd, 20, 11)


def test_equal_bytes_are_counted(spark):
    from docweave.llm.near_dedup import _same_bytes

    r = random.Random(5)
    rows = []
    for _ in range(500):
        a = bytes(r.choice([0, 1, 127, 128, 255]) for _ in range(4))
        b = bytes(x if r.random() < 0.5 else r.choice([0, 1, 127, 128, 255]) for x in a)
        rows.append((int.from_bytes(a, "little", signed=True), int.from_bytes(b, "little", signed=True), sum(x == y for x, y in zip(a, b))))
    frame = spark.createDataFrame(rows, "a int, b int, want int")
    assert frame.where(_same_bytes(frame.a, frame.b) != frame.want).count() == 0


def test_the_state_goes_on_with_a_second_arrival(spark, tmp_path):
    """Rows that arrive later meet the digests that earlier runs kept; a run without new rows changes nothing."""
    from docweave.llm.exact_dedup import read_state, run_state

    arrivals, checkpoint = str(tmp_path / "arrivals"), str(tmp_path / "state")
    schema = "doc_id long, _file string, _row long, digest binary, text_sha256 string"

    def arrive(rows):
        frame = spark.createDataFrame([(i, f, r, d.encode(), d) for i, f, r, d in rows], schema)
        frame.write.mode("append").parquet(arrivals)
        run_state(spark, arrivals, frame.schema, checkpoint)
        return {bytes(s.digest).decode(): (s.keeper.doc_id, s.n) for s in read_state(spark, checkpoint).collect()}

    assert arrive([(1, "f", 0, "a"), (2, "f", 1, "b")]) == {"a": (1, 1), "b": (2, 1)}
    assert arrive([(9, "g", 0, "a"), (1, "g", 1, "b"), (3, "g", 2, "c")]) == {"a": (9, 2), "b": (2, 2), "c": (3, 1)}
    run_state(spark, arrivals, spark.read.parquet(arrivals).schema, checkpoint)
    assert {bytes(s.digest).decode(): s.n for s in read_state(spark, checkpoint).collect()} == {"a": 2, "b": 2, "c": 1}
