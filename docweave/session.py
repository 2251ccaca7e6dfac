"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

PARQUET_CODEC = "spark.sql.parquet.compression.codec"
PARQUET_PAGE = "parquet.page.size"
#: The codec finds copies within a page, up to 2 MB back; a page of 8 MB holds a text's first copy less often than one of 1 MB.
REPEATED_CODEC, REPEATED_PAGE = "zstd", 8 * 1024 * 1024


def build_session(app_name: str = "docweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; `conf` uses `_` for `.` in names."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    settings.update({name.replace("_", "."): value for name, value in conf.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def session_for_repeated_texts(spark: SparkSession) -> SparkSession:
    """A session like `spark` whose Parquet files find a text again that many rows repeat, each inside a string of its own.

    No dictionary holds such strings, and Spark's default codec finds copies within 64 KB only. Data frames keep the session
    they were made in, so the codec holds for them and nothing else; runtime settings are taken over, temporary views are
    not. A codec that `spark` names itself stays, and then `spark` is returned; a page size it names stays too.
    """
    settings = spark.conf.getAll
    if PARQUET_CODEC in settings:
        return spark
    own = spark.newSession()
    for name, value in settings.items():
        # What is fixed when Spark starts is shared and cannot be set.
        at_runtime = spark.conf.isModifiable(name) or not name.startswith("spark.") or name.startswith("spark.sql.catalog.")
        if at_runtime and own.conf.get(name, None) != value:
            own.conf.set(name, value)
    own.conf.set(PARQUET_CODEC, REPEATED_CODEC)
    if PARQUET_PAGE not in settings:
        own.conf.set(PARQUET_PAGE, str(REPEATED_PAGE))
    return own


def allow_legacy_charsets(spark: SparkSession) -> None:
    """Let readers, writers and encode/decode use charsets outside the default list (cp949 here)."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
