import random
from itertools import permutations

import numpy as np
from tokenizers import Tokenizer

from docweave.llm.bpe import IdEncoder, TokenCounter
from docweave.llm.packing import END, best_fit_decreasing, lower_bound, pack, pack_documents, pieces, sequences
from docweave.llm.token_counts import token_counts


def odd_texts(n, seed):
    r = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "a", "the", " cat", "'s", "'S", "!", "12", "é", "aaaa", "<|endoftext|>", "\xa0", " \n ", "<|", "\x1c", "日本", "😀"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_counts_and_ids_are_those_of_the_library(byte_bpe):
    library = Tokenizer.from_file(byte_bpe)
    texts = odd_texts(4_000, 1) + [f"x{chr(c)}y {chr(c)}1 {chr(c)}" for c in range(1, 0x3100)] + ["a" * 3_000, "ab" * 2_000]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert TokenCounter(byte_bpe).counts(texts) == [len(ids) for ids in want]
    encoder = IdEncoder(byte_bpe)
    assert all(encoder.ids(text) == np.array(ids, "<u4").tobytes() for text, ids in zip(texts, want))


def test_token_counts_of_odd_rows(odd, empty, odd_rows, byte_bpe):
    library = Tokenizer.from_file(byte_bpe)
    got = token_counts(odd, byte_bpe).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in odd_rows]
    key = lambda row: (row[0] is None, row[0] or 0, row[1], row[2])
    assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in got], key=key) == sorted(want, key=key)
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    assert token_counts(empty, byte_bpe).count() == 0


def test_lower_bound_never_exceeds_the_best_packing():
    r = random.Random(3)
    for _ in range(150):
        lengths = [r.randint(1, 20) for _ in range(r.randint(1, 6))]
        best = len(lengths)
        for order in permutations(lengths):
            bins = []
            for length in order:
                place = next((i for i, load in enumerate(bins) if load + length <= 20), None)
                if place is None:
                    bins.append(length)
                else:
                    bins[place] += length
            best = min(best, len(bins))
        assert lower_bound(np.array(lengths), 20) <= best
    assert lower_bound(np.array([11] * 7), 20) == 7 and lower_bound(np.array([], np.int64), 20) == 0


def test_best_fit_places_every_item_gaplessly():
    lengths = np.random.default_rng(1).integers(1, 1025, 5_000)
    bins, offsets, loads = best_fit_decreasing(lengths, 1024)
    assert loads.max() <= 1024 and loads.sum() == lengths.sum() and len(loads) <= 1.01 * lower_bound(lengths, 1024)
    order = np.lexsort((offsets, bins))
    ends = np.concatenate([np.cumsum(lengths[order][bins[order] == b]) for b in range(len(loads))])
    assert (ends - lengths[order] == offsets[order]).all()


def check_packed(rows, capacity):
    by_sequence = {}
    for row in rows:
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_groups_with_gaps_exchange_documents(spark):
    lengths = np.random.default_rng(2).integers(1, 1025, 6_000)
    items = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "doc_id long, length long").repartition(6).cache()
    alone = check_packed(pack(items, group_items=200, rounds=1).collect(), 1024)
    rows = pack(items, group_items=200, rounds=4).collect()
    assert sorted(r.doc_id for r in rows) == list(range(6_000))
    together = check_packed(rows, 1024)
    assert lower_bound(lengths, 1024) <= together < alone


def test_repeated_and_null_rows_are_dealt_evenly(spark):
    items = spark.createDataFrame([(None, 600)] * 900, "doc_id long, length long")
    rows = pack(items, group_items=100).collect()
    assert len(rows) == 900 and check_packed(rows, 1024) == 900


def test_pieces_and_sequences_of_odd_rows(odd, empty, odd_rows, byte_bpe):
    library = Tokenizer.from_file(byte_bpe)
    cut = pieces(odd, byte_bpe, capacity=64, with_ids=True).cache()
    packed = pack(cut, 64, group_items=50).cache()
    check_packed(packed.collect(), 64)
    want = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in odd_rows)
    built = sequences(packed).collect()
    assert sum(r.n_ids for r in built) == want and all(len(r.ids) == 4 * r.n_ids <= 256 for r in built)
    of_4 = sorted((r.piece, r.start, r.length, bytes(r.ids)) for r in cut.where("doc_id = 8").collect())
    ids = np.array([*library.encode(odd_rows[-1][1], add_special_tokens=False).ids, END], "<u4").tobytes()
    assert b"".join(part[3] for part in of_4) == ids
    long = sorted((r.piece, r.start, r.length) for r in cut.where("doc_id = 5").collect())
    assert all(length == 64 for _, _, length in long[1:]) and all(a[1] + a[2] == b[1] for a, b in zip(long, long[1:]))
    assert pack_documents(empty, byte_bpe).count() == 0
