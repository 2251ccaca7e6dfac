"""Sessions whose files find repeated texts again."""

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

from docweave.session import PARQUET_CODEC, session_for_repeated_texts
from workload.queries import QUERIES


def _words(doc_id: int, n: int, length: int) -> list[str]:
    """Words without inner repeats, so that only copies of a whole text can be found again."""
    digests = lambda word: (hashlib.sha256(f"{doc_id} {word} {i}".encode()).hexdigest() for i in range(length // 64))
    return ["".join(digests(word)) for word in range(n)]


def _size(path) -> int:
    return sum(file.stat().st_size for file in Path(path).glob("*.parquet"))


@pytest.fixture
def long_documents(spark, tmp_path):
    """Four texts of about 100 KB, each more than Snappy looks back."""
    texts = [" ".join(_words(doc_id, 50, 1984)) for doc_id in range(4)]
    docs = spark.createDataFrame([*enumerate(texts), (4, None), (5, "")], "doc_id long, text string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path), texts


def test_tagged_records_do_not_store_the_content_once_per_record(spark, long_documents, tmp_path):
    sf_dir, texts = long_documents
    out = f"{tmp_path}/records"
    QUERIES["tagged_records"](spark, sf_dir).write.parquet(out)
    rows = spark.read.parquet(out).collect()
    held = [sum(text in row.record for row in rows) for text in texts]
    assert min(held) >= 40 and sum(held) == len(rows)
    # Their contents take more than 40 times as much as the texts.
    assert _size(out) < 3 * sum(map(len, texts))


def test_the_callers_session_stays_as_it_is(spark, long_documents, tmp_path):
    before, active = spark.conf.getAll, SparkSession.getActiveSession()
    records = QUERIES["tagged_records"](spark, long_documents[0])
    records.write.parquet(f"{tmp_path}/records")
    assert spark.conf.getAll == before and PARQUET_CODEC not in before
    assert SparkSession.getActiveSession()._jsparkSession.equals(active._jsparkSession)
    spark.range(3).write.parquet(f"{tmp_path}/others")
    assert all(".snappy." in file.name for file in Path(f"{tmp_path}/others").glob("*.parquet"))
    assert records.join(spark.range(1)).count() == records.count() > 0


def test_settings_are_taken_over_and_a_named_codec_stays(spark):
    names = {"spark.sql.shuffle.partitions": "7", "spark.sql.ansi.enabled": "false", "parquet.page.size": "65536"}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        own = session_for_repeated_texts(spark)
        assert {name: own.conf.get(name) for name in names} == names
        assert own.conf.get(PARQUET_CODEC) == "zstd" and own.conf.get("spark.sql.session.timeZone") == "UTC"
        spark.conf.set(PARQUET_CODEC, "gzip")
        assert session_for_repeated_texts(spark) is spark
    finally:
        spark.conf.unset(PARQUET_CODEC)
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
