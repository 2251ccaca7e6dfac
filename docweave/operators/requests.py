"""The export request queue: pending requests, their names, their datasets and their status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docweave.bounds import broadcast_if_small
from docweave.functions.text import BLANK

# Channel labels and request states.
ALL_CHANNELS, SOME_CHANNELS = "전채널", "채널일부"
PENDING, IN_PROGRESS, DONE = "I", "P", "C"

# Columns of a request.
REQUEST_COLUMNS = [
    "seq", "user_seq", "type_cd", "account_seq", "reg_dt", "datasets", "channel", "start_date", "end_date",
    "compare_yn", "campaign_seq",
]


def pending_requests(queue: DataFrame, users: DataFrame, statuses: tuple[str, ...] = (PENDING,)) -> DataFrame:
    """Requests of active users in one of `statuses`, with dates as text."""
    active = broadcast_if_small(users.where(F.col("use_yn") == "Y").select(F.col("seq").alias("_user")))
    return (
        queue.where(F.col("status").isin(*statuses))
        .join(active, F.col("user_seq") == F.col("_user"))
        .withColumns(
            {
                "reg_dt": F.date_format("reg_dt", "yyyyMMdd"),
                "start_date": F.date_format("start_date", "yyyy-MM-dd HH:mm:ss"),
                "end_date": F.date_format("end_date", "yyyy-MM-dd HH:mm:ss"),
            }
        )
        .select(*REQUEST_COLUMNS)
    )


def with_type_names(requests: DataFrame, codes: DataFrame) -> DataFrame:
    """Add the name of the request type; the first name by alphabet where a code has several."""
    names = codes.groupBy("type_cd").agg(F.min("name").alias("type_name"))
    return requests.join(broadcast_if_small(names), "type_cd", "left")


def with_datasets(requests: DataFrame) -> DataFrame:
    """One row per dataset of a request. Without datasets one row with a null `dataset_seq` remains."""
    listed = F.when(F.trim("datasets") != "", F.col("datasets"))
    return requests.select("*", F.explode_outer(F.array_distinct(F.split(listed, ",", -1))).alias("_dataset")).select(
        *requests.columns, F.trim("_dataset").try_cast("int").alias("dataset_seq")
    )


def with_rules(requests: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per active rule of a request's dataset; `rule_id` is null for a dataset without any."""
    active = rules.where(F.col("use_yn") == "Y").select(F.col("dataset_seq").alias("_dataset"), "rule_id")
    bounded = broadcast_if_small(active)
    return requests.join(bounded, F.col("dataset_seq") == F.col("_dataset"), "left").drop("_dataset")


def with_file_names(requests: DataFrame) -> DataFrame:
    """Add `directory` and `file_name` of an export: date and number, then everything that was asked for.

    Input has `type_name` and `dataset_seq`; a missing part is left out of the name.
    """
    digits = lambda name: F.regexp_replace(name, f"[-:{BLANK}]", "")
    every = F.col("channel").isNull() | F.col("channel").isin("", "all")
    label = F.when(every, ALL_CHANNELS).otherwise(SOME_CHANNELS)
    dates = [F.substring(digits(name), 1, 8) for name in ("start_date", "end_date")]
    return requests.withColumns(
        {
            "directory": F.concat_ws("/", digits("reg_dt"), F.col("seq").cast("string")),
            "file_name": F.concat_ws(
                "_", F.col("seq").cast("string"), "type_name", label, *dates, F.col("dataset_seq").cast("string")
            ),
        }
    )


def swap_extension(path: str, extension: str):
    """Output path of a job that keeps its input's name: the last extension is replaced."""
    return F.regexp_replace(path, r"\.[_0-9a-zA-Z]+\z", extension)


def current_status(events: DataFrame) -> DataFrame:
    """Latest status of every request from an append-only table (seq, event_no, status).

    Of events with the same number the one furthest on (I, P, C) counts.
    """
    on = F.when(F.col("status") == PENDING, 0).when(F.col("status") == IN_PROGRESS, 1).otherwise(2)
    return events.groupBy("seq").agg(F.max_by("status", F.struct("event_no", on)).alias("status"))


def with_current_status(queue: DataFrame, events: DataFrame) -> DataFrame:
    """The queue with statuses that later events have changed."""
    latest = current_status(events).withColumnRenamed("status", "_latest")
    return (
        queue.join(latest, "seq", "left")
        .withColumn("status", F.coalesce("_latest", "status"))
        .select(*queue.columns)
    )


def open_requests(queue: DataFrame, events: DataFrame, now: Column) -> DataFrame:
    """Requests that a run may take up, with status I.

    Open are those whose last status, in the log or else in the queue, is I, and those in progress (P) whose lease has
    ended: the run that held it has failed. A request that is in progress without a lease is open too.
    """
    last = events.groupBy("seq").agg(F.max_by(F.struct("status", "expires"), "event_no").alias("_last"))
    status = F.coalesce("_last.status", "status")
    ended = F.col("_last.expires").isNull() | (F.col("_last.expires") < now)
    return (
        queue.join(last, "seq", "left")
        .where((status == PENDING) | ((status == IN_PROGRESS) & ended))
        .withColumn("status", F.lit(PENDING))
        .select(*queue.columns)
    )


def owned_requests(events: DataFrame, run_id: str) -> DataFrame:
    """`seq` of the requests that are in progress and were taken up by `run_id` last."""
    last = events.groupBy("seq").agg(F.max_by(F.struct("status", "run_id"), "event_no").alias("_last"))
    return last.where((F.col("_last.status") == IN_PROGRESS) & (F.col("_last.run_id") == run_id)).select("seq")


def finished_runs(events: DataFrame) -> DataFrame:
    """(seq, run_id): the run that finished each request last."""
    done = events.where(F.col("status") == DONE)
    return done.groupBy("seq").agg(F.max_by("run_id", "event_no").alias("run_id"))
