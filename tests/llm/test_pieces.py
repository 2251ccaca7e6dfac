import random
import struct
import zlib
from functools import lru_cache

import public_tokenizers
import sentencepiece

from docweave.llm import pieces
from docweave.llm.pieces import Segmenter, decode, encode, encoding_report, piece_model

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def all_paths(model, text):
    """Every segmentation with its score, best first."""
    text = model.normalized(text)
    arcs = model.arcs(text)

    @lru_cache(None)
    def up_to(end):
        if not end:
            return [(0.0, ())]
        return [(done + score, ids + model.arc_ids(text[start:end])) for start, e, score in arcs if e == end for done, ids in up_to(start)]

    return sorted(up_to(len(text)), key=lambda path: -path[0])


def test_paths_are_the_best_of_all():
    model, library, r = piece_model(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL), random.Random(2)
    for n in (1, 2, 3, 5):
        segmenter = Segmenter(MODEL, n)
        for _ in range(150):
            text = "".join(r.choice(list("abthe  in é日①😀\n")) for _ in range(r.randint(0, 9)))
            want, got = all_paths(model, text), segmenter.segmentations(segmenter.prepare([text])[0])
            assert [p[0] for p in got] == [p[0] for p in want[:n]] and len({p[1] for p in got}) == len(got)
            for path in got:
                assert path in want and model.decode(list(path[1])) == text
                assert not text or library.decode(list(path[1])) == text


def test_many_words_at_once_are_as_one_by_one():
    model, r = piece_model(MODEL), random.Random(3)
    words = ["▁" * r.randint(0, 2) + "".join(r.choice("abcdetinrs①é") for _ in range(r.randint(1, 30))) for _ in range(300)]
    for word, found in zip(words, model.best_of(words)):
        assert found == model.best(word)


def test_ids_do_not_depend_on_how_words_are_searched(spark, monkeypatch):
    """All words of a table, ties among them: the search of many words, of one word, and of n paths agree on the best ids."""
    model = piece_model(MODEL)
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    words = sorted({word for text in texts for word in pieces._WORDS.findall(model.normalized(text)) if len(word) <= pieces.SHORT}, key=len)
    ties = 0
    for start in range(0, len(words), 4_096):
        block = words[start : start + 4_096]
        for word, found in zip(block, model.best_of(block)):
            assert found == model.best(word)
            if found[2] == 0:
                ties += 1
                assert model.n_best(word, 1)[0] == found[:2]
    assert ties > 100 and len(words) > 20_000
    docs = spark.createDataFrame([(i, text) for i, text in enumerate(texts[:60])], "doc_id long, text string")
    reports = []
    for short in (0, 40, 10_000):
        segmenter = Segmenter(MODEL, 3)
        monkeypatch.setattr(pieces, "SHORT", short)
        reports.append([segmenter.segmentations(p) for p in segmenter.prepare([r.text for r in docs.collect()])])
    assert reports[0] == reports[1] == reports[2]


def test_the_report_is_that_of_the_paths(spark, make_docs):
    texts = ["one two  three", "", "$$|$ é①x", "a ▁ b", "word " * 300]
    model = piece_model(MODEL)
    encoded = {r.doc_id: r.paths for r in encode(make_docs(texts), MODEL, 3).collect()}
    for row in encoding_report(make_docs(texts), MODEL, 3).collect():
        text, paths = texts[row.doc_id], encoded[row.doc_id]
        ids = list(paths[0].ids)
        assert row.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)) and row.n_pieces == len(ids)
        assert (row.score, row.last_score, row.n_found) == (paths[0].score, paths[-1].score, len(paths))
        assert row.round_trip == all(model.decode(list(path.ids)) == text for path in paths) and row.round_trip == ("▁" not in text)
        if len(text) < 20:
            assert [p.score for p in paths] == [p[0] for p in all_paths(model, text)[: len(paths)]]


def test_round_trip_of_odd_rows(odd, odd_rows, empty):
    report = encoding_report(odd, MODEL).collect()
    assert len(report) == len(odd_rows) and all(x.round_trip for x in report)
    assert {(x.n_pieces, x.score, x.n_found) for x in report if x.doc_id == 1} == {(0, 0.0, 1)}
    encoded = encode(odd.where("doc_id in (2, 4, 8)"), MODEL, 2).selectExpr("doc_id", "paths[0].ids AS ids", "size(paths) AS n")
    texts = sorted((x.doc_id, x.text) for x in decode(encoded, MODEL).collect())
    assert texts == sorted((i, t or "") for i, t in odd_rows if i in (2, 4, 8))
    assert encoding_report(empty, MODEL).count() == 0 and encode(empty, MODEL).count() == 0
