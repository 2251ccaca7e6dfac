import random
import re

import pytest
from pyspark.sql import functions as F

from docweave.functions import hangul, tags, text as T
from docweave.functions.dictionary import let
from docweave.functions.hangul import compose_jamo
from docweave.functions.tags import KOREAN_AND_LATIN
from docweave.functions.topics import topic_words
from docweave.operators import tagging


def test_strip_removes_what_python_strips(value):
    for text in ["\u00a0 가 \u3000", "\x1c나\x85", "  ", "", "다\r\n"]:
        assert value(T.strip, text) == text.strip()


def test_character_patterns_in_spark(spark):
    body = tags.KOREAN.kept + T.BLANKS
    points = [c for c in [*range(1, 0x2100), 0x3000, 0x3131, 0x314F, 0xAC00, 0xD7A3, 0xD7A4, 0xFFFD, 0x1F600]]
    rows = spark.createDataFrame([(chr(c),) for c in points], "c string")
    plain = re.compile(f"[{body}]")
    for row in rows.select("c", F.col("c").rlike(T.outside(body)).alias("o"), F.col("c").rlike(T.inside(body)).alias("i")).collect():
        assert row.o != bool(plain.match(row.c)) and row.i == bool(plain.match(row.c)), hex(ord(row.c))


def test_sentences_of_both_kinds(value):
    assert value(lambda c: T.sentences(c), "가. 나.다") == ["가", " 나", "다"]
    text = "좋아요!! 별로~^^ 그래-서_끝?"
    assert value(lambda c: T.sentences(c, tags.SENTENCE_END_MULTI), text) == re.split(r"[.\-_~^?!]+", text)


def test_tagger_input(value):
    assert value(T.blank_punctuation, " 값,이\r\n싸다!") == "값 이싸다 "
    assert value(T.tagger_input, "값(이) 싸다\nok? é1") == "값이 싸다ok 1"
    assert value(lambda c: T.tagger_input(c, KOREAN_AND_LATIN), "é1 ☆") == "é1"


def test_strip_tags(value):
    text = "가격/NNG+이/J_ 싸/VA+다/EF"
    assert value(T.strip_tags, text) == re.sub(r"/[A-Z]+[_]*[\+]*", "", text) == "가격이 싸다"


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("어제 산 <em>파란</em><em>우산</em> <em>손잡이</em>에서 작은 흠집을 찾았다", ["어제", "산", "작은", "흠집을", "찾았다"]),
        ("앞 <em>530d</em> 뒤", ["앞", "em", "530d", "em", "뒤"]),
        ("<em>가</em>", []),
    ],
)
def test_close_words(value, text, expected):
    assert value(T.close_words, text) == expected


def test_corpus_line(value):
    assert value(T.corpus_line, "가격/NNG+이/J_ 싸/VA") == "가격/NNG 이/J_ 싸/VA "
    assert value(T.corpus_line, "가\u3000나") == "가 나 "


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("가ㅂ니다", "갑니다"), ("하ㄴ다", "한다"), ("ㅎㅏㄴㄱㅡㄹ", "한글"), ("각ㅏ", "가가"), ("갃ㅏ", "갃ㅏ"), ("닭ㅇ", "닭ㅇ"),
        ("그대로 text 1", "그대로 text 1"), ("ㅋㅋㅋ", "ㅋㅋㅋ"), ("ㅠㅠ", "ㅠㅠ"), ("아ㄴ 녕", "안 녕"), ("a하ㄹ까?", "a할까?"), ("", ""),
    ],
)
def test_compose_jamo(value, text, expected):
    assert value(compose_jamo, text) == expected


def test_composing_leaves_all_syllables_alone(spark):
    every = "".join(chr(c) for c in range(0xAC00, 0xD7A4))
    # A single letter in the run makes every syllable go through decomposition and back.
    rows = spark.createDataFrame([("ㅋ" + every,)], "t string")
    assert rows.select(compose_jamo(F.col("t"))).first()[0] == "ㅋ" + every


@pytest.mark.parametrize(
    ("tagged", "expected"),
    [
        ("가격/NNG+할인/NNG+이/J_", ["가격할인"]), ("사랑/XR+하/XSV+다/EF", ["사랑하다"]), ("공부/NNG+하/XSV", ["공부"]),
        ("서울/NNP", ["서울"]), ("BMW/SL", ["BMW"]), ("a/NFU b/NFG c/FL", ["a", "b", "c"]), ("가/VV+다/EF 곱/VA", ["가다", "곱다"]),
        ("은/J_", []), ("", []),
    ],
)
def test_topic_words(value, tagged, expected):
    assert value(topic_words, tagged) == expected


def test_dictionary_form(spark):
    rows = spark.createDataFrame([("좋/VA", "VA"), ("깨끗/XR", "XR"), ("차", "NNG")], "t string, k string")
    got = [r[0] for r in rows.select(T.dictionary_form(F.col("t"), F.col("k"))).collect()]
    assert got == ["좋다", "깨끗하다", "차"]


def test_recomposition_of_pieces_equals_that_of_whole_runs(spark):
    """The plain rule in Python: all syllables of a run of Hangul are taken apart, and units are put together from the left."""
    leads, vowels, tails = hangul.LEADS, hangul.VOWELS, [""] + list(hangul.TAILS)
    clusters, leads_only = "ㄳㄵㄶㄺㄻㄼㄽㄾㄿㅀㅄ", "ㄸㅃㅉ"

    def whole(text):
        letters = ""
        for c in text:
            n = ord(c) - 0xAC00
            letters += leads[n // 588] + vowels[n % 588 // 28] + tails[n % 28] if "가" <= c <= "힣" else c
        out, i = "", 0
        while i < len(letters):
            at = lambda k: letters[k] if k < len(letters) else ""
            is_vowel = lambda c: "ㅏ" <= c <= "ㅣ"
            is_letter = lambda c: "ㄱ" <= c <= "ㅎ"
            if is_letter(at(i)) and at(i) not in clusters and is_vowel(at(i + 1)):
                tail = at(i + 2)
                closes = is_letter(tail) and tail not in leads_only and (tail in clusters or not is_vowel(at(i + 3)))
                out += chr(0xAC00 + leads.index(at(i)) * 588 + vowels.index(at(i + 1)) * 28 + (tails.index(tail) if closes else 0))
                i += 3 if closes else 2
            else:
                out, i = out + at(i), i + 1
        return out

    rng = random.Random(3)
    texts = ["".join(rng.choice("가각갃값나낙닭힣하ㄱㄴㄷㄸㅃㄳㄺㅄㅎㅏㅑㅣㅗx \n1") for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", hangul.compose_jamo(F.col("t")).alias("got")).collect()
    assert [(r.t, r.got) for r in rows if r.got != whole(r.t)] == []


def test_let_does_not_work_out_its_type_for_each_row(spark):
    """Taken by its place, an element has the type of the whole body worked out for each row."""
    rows = spark.range(3).select(let(F.col("id") + 1, lambda x: F.struct(x.alias("a"), (x * 2).alias("b"))).alias("v"))
    assert "array_max(transform(" in rows._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r.v) for r in rows.collect()] == [(1, 2), (2, 4), (3, 6)]
    assert spark.range(1).select(let(F.lit(None).cast("string"), lambda x: x).alias("v")).first().v is None


def test_words_are_split_at_every_blank(value):
    text = "Ab\u3000c\u00a0d\te\u2028f\u1680g\x1ch\x85i j\nk\r\nl"
    assert value(lambda c: tagging._words(c, KOREAN_AND_LATIN), text) == ["ab", "c", "d", "e", "f", "g", "h", "i", "jkl"]
