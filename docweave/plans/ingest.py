"""Taking in raw records: good rows, rows set apart, and counts of both from one pass over the files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from docweave.operators import payload
from docweave.sources.files import RECORD, rootless_records

#: State of a record that is no XML of the expected form.
BROKEN = "broken"
STATES = (payload.OK, payload.NO_RESULT, payload.UNDECODABLE, BROKEN)


@dataclass(frozen=True)
class Ingested:
    """What was taken in. `counts` has the number of records per state."""

    records: DataFrame
    quarantine: DataFrame
    counts: dict[str, int]


def ingest_records(spark: SparkSession, path: str, out_path: str, tag: str = "Doc") -> Ingested:
    """XML records without a root to a table by state, each file read and each record parsed once.

    `records` (doc_id, content, state, JSON) holds the records that are XML, whatever the state of their payload.
    `quarantine` (state, raw) holds the text of those that are not, and the payload of those that cannot be decoded.
    Tables below `out_path` are partitioned by state, so readers of one state leave the others alone.
    """
    found = rootless_records(spark, path, tag, RECORD)
    broken = F.col("record._broken").isNotNull()
    fields = found.select(broken.alias("is_broken"), F.when(broken, F.col("value")).alias("value"), "record.*").drop("_broken")
    cleaned = payload.record_quality(payload.cleaned_records(fields, strip_ends=True).withColumn("body", F.col("JSON")), "body")
    state = F.when(F.col("is_broken"), BROKEN).otherwise(F.col("quality"))
    rows = cleaned.select("doc_id", F.coalesce("content", F.lit("")).alias("content"), "JSON", F.coalesce("value", "broken").alias("raw"), state.alias("state"))
    counts = Observation("states")
    rows.observe(counts, *[F.count_if(F.col("state") == name).alias(name) for name in STATES]).write.partitionBy("state").parquet(out_path)
    stored = spark.read.schema(rows.schema).parquet(out_path)
    return Ingested(
        stored.where(F.col("state") != BROKEN).select("doc_id", "content", "state", "JSON"),
        stored.where(F.col("raw").isNotNull()).select("state", "raw"),
        {name: counts.get[name] for name in STATES},
    )
