import public_tokenizers
import pytest

LONG = " ".join(f"word{i % 9000} and" for i in range(12_000))


@pytest.fixture(scope="session")
def byte_bpe():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text) with nulls, empty and very long texts, repeated rows, repeated ids."""
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (4, "one two three"), (4, "another text of the same id"),
        (None, "one two three"), (None, None), (5, LONG), (6, LONG), (7, "a" * 5_000), (8, "tab\tand\x0bline\nends <|endoftext|> x"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with extra columns whose names the operators use themselves."""
    clashing = "kept boolean, n_words int, score string, row int, node int, piece int, digest string, label int, rank string, lang string"
    values = (True, 1, "s", 2, 3, 4, "d", 1, "r", "en")
    return spark.createDataFrame([(*row, *values) for row in odd_rows], f"doc_id long, text string, {clashing}").repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="session")
def make_docs(spark):
    return lambda texts, first=0: spark.createDataFrame([(first + i, text) for i, text in enumerate(texts)], "doc_id long, text string")
