"""Exact deduplication with streaming state.

Arrivals (digest, id, place of the text) go through a streaming aggregation whose keyed state is kept on disk by
RocksDB and never expires. For each digest it holds the row that stays, by id and place, and the size of the group.
The state is then read as a table. A hit is believed only after its whole text was compared with the text that stays.
Everything runs inside the JVM.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.llm import common
from docweave.scratch import remove_tables

#: The state is kept on disk. Its many small stores do not reserve space ahead (4 MB for each partition), share one bound
#: of memory in an executor, and buffer little each.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
}


def located(docs: DataFrame) -> DataFrame:
    """`docs` with the place of each row (file, row); rows that come from no file are written to the shared folder first."""
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    if {"_file", "_row"} <= set(docs.columns):
        return docs
    try:
        return docs.select("*", *place)
    except AnalysisException:
        return common.written(docs, "located").select("*", *place)


def run_state(spark: SparkSession, arrivals_path: str, schema, checkpoint: str) -> None:
    """Bring the keyed state below `checkpoint` up to date with the arrivals; a later or repeated run goes on from it."""
    arrivals = spark.readStream.schema(schema).parquet(arrivals_path)
    state = arrivals.groupBy("digest").agg(
        F.max(F.struct("doc_id", "_file", "_row")).alias("keeper"), F.count(F.lit(1)).alias("n")
    )
    before = {name: spark.conf.get(name, None) for name in _STATE}
    for name, value in _STATE.items():
        spark.conf.set(name, value)
    try:
        query = (
            state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state as a table: digest, keeper (doc_id, _file, _row), n."""
    table = spark.read.format("statestore").load(checkpoint)
    keeper, n = (f"value.{field.name}" for field in table.schema["value"].dataType.fields)
    return table.select(F.col("key.digest").alias("digest"), F.col(keeper).alias("keeper"), F.col(n).alias("n"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=None) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256, _file, _row.

    Texts are equal when their bytes are. A null text counts as the empty text. Of equal texts the row with the largest
    id stays; null ids come last, and of repeated rows with the same id the one that lies last stays. An empty table
    gives an empty result. `digest` maps a text column to the key of the state; texts whose digests collide are kept
    apart because their bytes differ.
    """
    spark = docs.sparkSession
    digest = digest or (lambda text: F.unhex(F.sha2(text, 256)))
    source = located(docs).select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), "_file", "_row"
    )
    path, checkpoint = common.fresh_path(spark, "arrivals"), common.fresh_path(spark, "dedup-state")
    keyed = source.withColumn("digest", digest(F.col("text")))
    keyed.select("doc_id", "_file", "_row", "digest", F.sha2("text", 256).alias("text_sha256")).write.parquet(path)
    arrivals = spark.read.parquet(path)
    run_state(spark, path, arrivals.schema, checkpoint)
    state = common.written(read_state(spark, checkpoint), "groups")
    remove_tables(spark, [checkpoint])

    other = common.written(_different_bytes(keyed, state), "different")
    other_groups = other.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "_file", "_row")).alias("keeper"), F.count(F.lit(1)).alias("n")
    )
    moved = other.join(other_groups, ["digest", "text"]).select(
        "_file", "_row", F.col("keeper").alias("own_keeper"), F.col("n").alias("own_n")
    )
    lost = other.groupBy("digest").agg(F.count(F.lit(1)).alias("lost"))
    groups = state.join(lost, "digest", "left").select(
        "digest", "keeper", (F.col("n") - F.coalesce("lost", F.lit(0))).alias("n")
    )
    rows = arrivals.join(groups, "digest").join(moved, ["_file", "_row"], "left")
    keeper = F.coalesce("own_keeper", "keeper")
    return rows.select(
        "doc_id", keeper["doc_id"].alias("keep_id"), F.coalesce("own_n", "n").alias("group_size"),
        ((keeper["_file"] == F.col("_file")) & (keeper["_row"] == F.col("_row"))).alias("kept"),
        "text_sha256", "_file", "_row",
    )


def _different_bytes(keyed: DataFrame, state: DataFrame) -> DataFrame:
    """Rows that share the digest of the row that stays but not its bytes: digest, text, doc_id, _file, _row."""
    hits = state.where("n > 1").select("digest", "keeper")
    members = keyed.join(common.small(hits), "digest")
    stays = (F.col("keeper._file") == F.col("_file")) & (F.col("keeper._row") == F.col("_row"))
    first = members.where(stays).select("digest", F.col("text").alias("first_text"))
    return (
        members.where(~stays).select("digest", "text", "doc_id", "_file", "_row")
        .join(first, "digest").where("text != first_text").drop("first_text")
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with their columns (names that begin with an underscore are kept for places)."""
    source = located(docs)
    gone = exact_dedup(source).where(~F.col("kept")).select(F.col("_file").alias("_gone_file"), F.col("_row").alias("_gone_row"))
    same = (F.col("_file") == F.col("_gone_file")) & (F.col("_row") == F.col("_gone_row"))
    return source.join(common.small(common.written(gone, "gone")), same, "left_anti").select(*docs.columns)
