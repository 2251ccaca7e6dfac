import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import boosting
from docweave.llm.quality_classifier import SAMPLE_ROWS, quality_scores, statistics, train as train_quality
from docweave.llm.quality_rules import BASE, POLICIES, RULES, ablations, apply_policy, ledger, mask
from docweave.llm.secrets import ENCODINGS, base_spans, candidates, encoding, find_secrets, learn_limits, randomness, redact, redacted, written_spans
from docweave.llm.toxicity import drop_toxic, toxicity_scores, train as train_toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache(), spark.read.parquet(f"{SF}/labels.parquet").cache()


def accuracy(scores, labels, label, threshold):
    rows = scores.where("held_out").join(labels, "doc_id").select("score", "predicted", label).collect()
    assert len(rows) > 50 and all(0 <= r.score <= 1 and r.predicted == (r.score >= threshold) for r in rows)
    return sum(r.predicted == r[label] for r in rows) / len(rows)


def test_quality_of_held_out_rows_and_odd_rows(corpus, odd, odd_rows, empty):
    docs, labels = corpus
    model = train_quality(docs, labels)
    scores = quality_scores(docs, model).cache()
    assert accuracy(scores, labels, "quality", 0.3) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scores.collect())
    assert quality_scores(odd, model).count() == len(odd_rows) and quality_scores(empty, model).count() == 0


def test_toxicity_of_held_out_rows_and_odd_rows(corpus, odd, odd_rows, empty):
    docs, labels = corpus
    model = train_toxicity(docs, labels)
    scores = toxicity_scores(docs, model).cache()
    assert accuracy(scores, labels, "toxic", 0.7) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in scores.collect())
    clean = scores.join(labels, "doc_id").where("toxic = 0").agg(F.avg("predicted")).first()[0]
    assert clean < 0.01
    kept = drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scores.where("predicted = 0").collect()}
    assert toxicity_scores(odd, model).count() == len(odd_rows) and drop_toxic(odd, model).columns == odd.columns
    assert toxicity_scores(empty, model).count() == 0 and drop_toxic(empty, model).count() == 0


def test_no_labels_give_a_constant(spark, odd, odd_rows):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert {r.score for r in quality_scores(odd, train_quality(odd, none)).collect()} == {0.5}
    toxic = none.withColumnRenamed("quality", "toxic")
    assert toxicity_scores(odd, train_toxicity(odd, toxic)).where("predicted = 0").count() == len(odd_rows)


def test_trees_learn_and_flat_arrays_agree_with_a_walk():
    r = np.random.default_rng(1)
    x = r.normal(size=(3_000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(int)
    trees = boosting.fit(x[:2_000], y[:2_000], trees=60)
    scores = trees.score(x[2_000:])
    assert ((scores > 0.5) == y[2_000:]).mean() > 0.95
    for row, score in zip(x[2_000:2_050], scores):
        total = trees.start
        for node in trees.roots.tolist():
            for _ in range(trees.depth):
                node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            total += trees.value[node]
        assert abs(1 / (1 + np.exp(-total)) - score) < 1e-12


def test_calibration_rises_and_follows_shares():
    r = np.random.default_rng(2)
    scores = r.random(5_000)
    y = (r.random(5_000) < scores**2).astype(int)
    fitted = boosting.isotonic(scores, y)(np.linspace(0, 1, 50))
    assert (np.diff(fitted) >= 0).all() and np.abs(fitted - np.linspace(0, 1, 50) ** 2).max() < 0.1
    assert boosting.isotonic(np.zeros(0), np.zeros(0))(np.array([0.3]))[0] == 0.3


def test_statistics_do_not_depend_on_length():
    once, often = statistics("a b. c d!\n" * 50), statistics("a b. c d!\n" * 500)
    assert once[1:10] == pytest.approx(often[1:10]) and statistics(" \n") == [0.0] * len(once) and SAMPLE_ROWS <= 20_000


def brute_base(text):
    out = []
    pattern = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(pattern, text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_base_spans_are_those_of_the_patterns():
    r = random.Random(4)
    parts = ["password", "PassWD", "secret", "token", "api_key", "APIkey", "=", ":", " ", '"', "'", "abcdefgh", "0123456789abcdef" * 2, "AKIA", "A1B2C3D4E5F6", "é", "\n", "toKen=", "toſen"]
    for _ in range(4_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert base_spans(text) == brute_base(text), text


def test_random_tokens_pass_and_ordinary_ones_do_not(make_docs):
    r = random.Random(6)
    kinds = ("upper_hex", "base32", "base62", "base64")
    secrets = ["".join(r.choice(ENCODINGS[kind]) for _ in range(40)) for kind in kinds for _ in range(30)]
    secrets = [s for s in secrets if encoding(s)]
    plain = [f"chapter{i}-of-the-long-introduction-and-overview" for i in range(60)] + [f"{'ab' * 12}{i}" for i in range(60)] + [f"release-2020-01-{i:02d}-of-the-program" for i in range(60)]
    assert np.mean([randomness(s, encoding(s)) < 0.05 for s in secrets]) < 0.15
    docs = make_docs([f"see {token} here" for token in secrets + plain])
    limits = learn_limits(docs)
    found = {x.doc_id: x for x in find_secrets(docs, limits).collect()}
    assert np.mean([found[i].n_random for i in range(len(secrets))]) > 0.85
    assert np.mean([found[i].n_random for i in range(len(secrets), len(secrets) + len(plain))]) < 0.05
    some = next(x for x in found.values() if x.n_random)
    assert some.spans == f"random:4:{4 + 40}"


def test_values_after_equals_signs_and_in_paths_are_judged(make_docs):
    forms = [
        "export AWS_SECRET_ACCESS_KEY={}\n", "private_key={}; x", "https://host.example/cb?sig={}&auth={}&n=1", "a=={}", "key={}== x", "k={}===",
        "https://host.example/reset/{}", "https://host.example/files/{}/name_of-file.txt", "/{}/{}?v=1", "0123456789abcdef0123456789abcdef/{}",
    ]
    r = random.Random(8)
    texts, wanted = [], []
    for form in forms * 12:
        tokens = [next(t for _ in iter(int, 1) if encoding(t := "".join(r.choice(ENCODINGS["base62"]) for _ in range(40))) == "base62") for _ in range(form.count("{}"))]
        texts.append(form.format(*tokens))
        wanted.append(tokens)
        judged = {texts[-1][start:end].rstrip("=") for start, end, _, _ in candidates(texts[-1], base_spans(texts[-1]))}
        assert judged >= set(tokens), texts[-1]
    assert [(start, end) for start, end, _, _ in candidates(f"key={'Ab1' * 9}== x", [])] == [(4, 33)]
    assert [(start, end) for start, end, _, _ in candidates(f"key={'Ab1' * 9}==x", [])] == [(4, 31)]
    limits = learn_limits(make_docs(texts))
    left = [any(token in redacted(text, limits) for token in tokens) for text, tokens in zip(texts, wanted)]
    assert np.mean(left) < 0.15


def test_secrets_of_odd_rows(odd, odd_rows, empty):
    rows = find_secrets(odd, learn_limits(odd)).collect()
    assert len(rows) == len(odd_rows)
    first = next(x for x in rows if x.doc_id == 1)
    assert (first.n_assign, first.n_access, first.n_hex, first.spans) == (0, 0, 0, "") and first.base_sha256 == hashlib.sha256(b"").hexdigest()
    assert find_secrets(empty, learn_limits(empty)).count() == 0 and redact(empty, {}).count() == 0
    assert redact(odd, {}).where("text is null").count() == 2 and redact(odd, {}).columns == odd.columns


def test_redaction_leaves_the_rest(spark):
    assert redacted("a password=abcdefgh12 b", {}) == "a [SECRET] b" and redacted("nothing", {}) == "nothing"
    text = "token = \"" + "0123456789abcdef" * 2 + "\" end"
    assert written_spans(base_spans(text)) == f"assign:0:{9 + 32},hex:9:{9 + 32}" and redacted(text, {}) == '[SECRET]" end'
    docs = spark.createDataFrame([(1, "x secret:abcdefghij", 20)], "doc_id long, text string, n_chars long")
    assert redact(docs, {}).first()[1:] == ("x [SECRET]", 10)


def brute_rules(text):
    words = [w.decode() for w in (text or "").encode().split()]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen: dict = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if line.encode().strip()]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_measurements_are_those_of_brute_force(make_docs, odd, odd_rows, empty):
    r = random.Random(8)
    texts = [" ".join(r.choice(["a", "b", "c d", "é#", "\n", "\n\n", "x|", "long\tword"]) for _ in range(r.randint(0, 60))) for _ in range(150)]
    rows = {x.doc_id: x for x in apply_policy(ledger(make_docs(texts)), 2).collect()}
    for i, text in enumerate(texts):
        x, want = rows[i], brute_rules(text)
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want
        assert x.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and x.kept == (not x.fail_bits)
    assert ledger(odd).count() == len(odd_rows) and ledger(empty).count() == 0
    assert {x.n_repeat_words for x in ledger(odd).where("doc_id = 5").collect()} == {brute_rules(odd_rows[8][1])[4]}


def test_policies_and_ablations_need_only_the_bits(spark):
    bits = [0, 0, 1, 2, 3, 4, 4, 6, 128]
    rows = spark.createDataFrame([(b,) for b in bits], "fail_bits int")
    for version, names in POLICIES.items():
        whole, got = mask(names), {r.rule: r for r in ablations(rows, version).collect()}
        assert set(got) == set(names)
        for name in names:
            own, n_kept = mask((name,)), sum(not b & whole for b in bits)
            x = got[name]
            assert (x.n_failed, x.n_kept) == (sum(bool(b & own) for b in bits), n_kept)
            assert x.n_kept_without == sum(not b & (whole & ~own) for b in bits) and x.n_only == x.n_kept_without - n_kept
    assert mask(BASE) == 3 and len(RULES) == 8
