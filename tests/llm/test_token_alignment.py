import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from docweave.llm import token_alignment as M
from docweave.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  two", "▁x", "a▁", "<|endoftext|> <s> </s> <unk> <0x41>", "é\xa0　x y", "\x00\x01", "ﬁ ① Ａ", "日本語🙂🙂", "a\r\n\r\n  b\t", "é", "x\u0085y\x1cz"]


@pytest.fixture(scope="module")
def libraries(byte_bpe):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(byte_bpe)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def _byte_of():
    """Bytes behind the letters of byte-level tokens: printable ones stand for themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


BYTE_OF = _byte_of()


def brute(text, libraries):
    """n_a, n_b, n_groups, n_links, text of the groups, links: by comparing every token of A with every token of B."""
    none = (0, 0, 0, 0, "", [])
    if not text:
        return none
    a, b = libraries[0].encode(" " + text, add_special_tokens=False), libraries[1].encode(text)
    bytes_a = [bytes(BYTE_OF[c] for c in token) for token in a.tokens]
    bytes_b = [bytes([int(p[3:5], 16)]) if libraries[1].is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [libraries[1].id_to_piece(i)]]
    raw = (" " + text).encode()
    if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return none
    ends_a, ends_b = np.cumsum([*map(len, bytes_a)]).tolist(), np.cumsum([*map(len, bytes_b)]).tolist()
    spans_a = list(zip([0, *ends_a], ends_a, a.ids))
    spans_b = list(zip([0, *ends_b], ends_b, b))
    links = [(x, y) for s, e, x in spans_a for t, u, y in spans_b if max(s, t) < min(e, u)]
    cuts = sorted(set(ends_a) & set(ends_b))
    side = lambda spans, low, high: ",".join(str(i) for s, e, i in spans if low < e <= high)
    groups = ";".join(f"{side(spans_a, low, high)}|{side(spans_b, low, high)}" for low, high in zip([0, *cuts], cuts))
    return len(a.ids), len(b), len(cuts), len(links), hashlib.sha256(groups.encode()).hexdigest(), links


def brute_rows(rows, libraries):
    found = [(doc_id, brute(text, libraries)) for doc_id, text in rows]
    held = Counter(pair for _, row in found for pair in set(row[5]))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return sorted(
        ((doc_id, *row[:4], sum(held[p] == most[p[0]] for p in row[5]), sum(held[p] for p in row[5]), row[4]) for doc_id, row in found), key=str
    )


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64, 1_000])
def test_merge_path_for_any_size_of_pieces(piece):
    rng = np.random.default_rng(piece)
    for _ in range(20):
        a = np.cumsum(rng.integers(1, 4, rng.integers(1, 60)))
        b = np.union1d(rng.choice(np.arange(1, a[-1] + 1), rng.integers(1, a[-1] + 1), False), a[-1])
        link_a, link_b, cut_a, cut_b = M.merge_path(a, b, piece)
        starts_a, starts_b = np.append(0, a[:-1]), np.append(0, b[:-1])
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if max(starts_a[i], starts_b[j]) < min(a[i], b[j])]
        assert list(zip(link_a.tolist(), link_b.tolist())) == want
        ends = np.intersect1d(a, b)
        assert a[cut_a - 1].tolist() == b[cut_b - 1].tolist() == ends.tolist()


def test_splits_lie_on_the_path():
    a, b = np.array([2, 2 + 1, 5, 9]), np.array([1, 3, 9])
    merged = sorted([(end, 0) for end in a] + [(end, 1) for end in b])
    assert M.splits(a, b, np.arange(8)).tolist() == [sum(side == 0 for _, side in merged[:d]) for d in range(8)]


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(4)
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    short = [(r.doc_id, r.text) for r in rows if len(r.text or "") < 600][:60]
    rows = short + [(10_000 + i, text) for i, text in enumerate(ODD)] + [(None, None), (None, "twice here"), (1, "twice here")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("common_pairs", [0, 50, M.COMMON_PAIRS])
def test_rows_are_those_of_brute_force(spark, mixed, libraries, byte_bpe, common_pairs):
    """All pairs joined by a shuffle, some of them, none: the same rows."""
    docs = spark.createDataFrame([(*row, 1, 2, "x") for row in mixed], "doc_id long, text string, row_no int, n_docs int, pairs string").repartition(3)
    got = sorted((tuple(r) for r in M.token_alignment(docs, byte_bpe, PIECES, common_pairs=common_pairs).collect()), key=str)
    assert got == brute_rows(mixed, libraries)


def test_long_text_and_empty_table(make_docs, empty, byte_bpe):
    text = "word and another " * 20_000
    row = M.token_alignment(make_docs([text]), byte_bpe, PIECES).first()
    assert row.n_links >= max(row.n_a, row.n_b) > 50_000 and row.count_sum == row.n_links
    assert M.token_alignment(empty, byte_bpe, PIECES).collect() == []


def test_query_is_that_of_brute_force(spark, libraries):
    """Counts over all documents; the rows of the shorter ones are compared with the quadratic search."""
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op13_token_alignment"](spark, SF_DIR).collect()}
    assert len(got) == len(rows)
    for row in [r for r in rows if len(r.text or "") < 1_500]:
        want, found = brute(row.text, libraries), got[row.doc_id]
        assert (found.n_a, found.n_b, found.n_groups, found.n_links, found.groups_sha256) == want[:5]
