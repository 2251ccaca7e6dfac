"""The export job: queue, matching, pages and manifest."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.bounds import broadcast_if_small
from docweave.operators import matching, paging, requests
from docweave.scratch import remove_tables, written_table
from docweave.sinks.commits import StatusLog
from docweave.sinks.files import read_pages, write_pages
from docweave.sources.tables import DOCUMENT_COLUMNS, STORED_COLUMNS

#: How long a run holds the requests that it has taken up.
LEASE = timedelta(hours=6)
MANIFEST_SCHEMA = "seq int, dataset_seq int, directory string, file_name string, total bigint, page bigint, n_rows bigint"


@dataclass
class ControlTables:
    queue: DataFrame
    users: DataFrame
    codes: DataFrame
    rules: DataFrame


def named_requests(control: ControlTables, statuses: tuple[str, ...] = (requests.PENDING,)) -> DataFrame:
    """Pending (request, dataset) rows with their directory and file name."""
    pending = requests.pending_requests(control.queue, control.users, statuses)
    return requests.with_file_names(requests.with_datasets(requests.with_type_names(pending, control.codes)))


def matched_documents(docs: DataFrame, control: ControlTables) -> DataFrame:
    wanted = requests.with_datasets(requests.pending_requests(control.queue, control.users))
    return matching.filter_documents(docs, wanted, control.rules)


def take_up(
    control: ControlTables, log: StatusLog, run_id: str, lease: timedelta, now: datetime | None, paths: list[str]
) -> DataFrame:
    """Rows of `named_requests` that this run holds the lease of; another run cannot take them up meanwhile.

    The claim is committed as the successor of the log version that the open requests were read from. If another run
    was faster, they are read again.
    """
    while True:
        version, moment = log.version(), now or datetime.now(timezone.utc)
        queue = requests.open_requests(control.queue, log.events(version), F.lit(moment))
        named = written_table(named_requests(replace(control, queue=queue)), "requests", paths)
        if named.isEmpty() or log.append(named, requests.IN_PROGRESS, version, run_id, moment + lease):
            return named


def finish(log: StatusLog, run_id: str) -> DataFrame:
    """`seq` of the requests that this run still holds, now committed as done."""
    while True:
        version = log.version()
        owned = requests.owned_requests(log.events(version), run_id)
        if owned.isEmpty() or log.append(owned, requests.DONE, version, run_id):
            return owned


def run_export(
    docs: DataFrame, control: ControlTables, base_dir: str, status_table: str, size: int = paging.PAGE_SIZE,
    run_id: str | None = None, lease: timedelta = LEASE, now: datetime | None = None,
) -> DataFrame:
    """Export the open requests and return the manifest of those that this run has finished.

    Any number of runs may share a base and a status log. Requests are taken up (P) by a commit that one run wins, with a
    lease; if the run fails, they are open again when its lease has ended. Pages and then the manifest are written to
    folders of the run, and the commit that marks the requests as done (C) makes them the live ones, all at once. A run
    that has lost its lease to another one finishes nothing. What is not live is never read: pages of failed runs, and
    pages that a later export of the same request has replaced, also by fewer ones.
    """
    spark, paths = docs.sparkSession, []
    log, run_id = StatusLog(spark, status_table), run_id or uuid.uuid4().hex
    named = take_up(control, log, run_id, lease, now, paths)
    kept = docs.select(*DOCUMENT_COLUMNS, *[name for name in STORED_COLUMNS if name in docs.columns])
    matched = written_table(matching.filter_documents(kept, named, control.rules).drop(*STORED_COLUMNS), "matched", paths)
    paged = paging.add_pages(matched, size)
    names = named.select(
        F.col("seq").alias("_seq"), F.col("dataset_seq").alias("_dataset"), "directory", F.col("file_name").alias("_name")
    )
    same = (F.col("seq") == F.col("_seq")) & F.col("dataset_seq").eqNullSafe(F.col("_dataset"))
    located = paged.join(broadcast_if_small(names), same).withColumn("file_name", F.concat("_name", paging.page_suffix(F.col("page"))))
    write_pages(located, f"{base_dir}/pages/run={run_id}")
    listed = paging.manifest(named, matched, size)
    listed.write.parquet(f"{base_dir}/manifests/run={run_id}")
    finished = written_table(finish(log, run_id), "finished", paths)
    manifest = spark.read.schema(listed.schema).parquet(f"{base_dir}/manifests/run={run_id}")
    done = written_table(manifest.join(finished.withColumnRenamed("seq", "_seq"), F.col("seq") == F.col("_seq"), "left_semi"), "manifest")
    remove_tables(spark, paths)
    return done


def live_manifest(spark: SparkSession, base_dir: str, status_table: str) -> DataFrame:
    """The manifest rows of the exports that were finished last, with the `run` that wrote their pages."""
    runs = requests.finished_runs(StatusLog(spark, status_table).events()).select(F.col("seq").alias("_seq"), F.col("run_id").alias("_run"))
    listed = spark.read.schema(f"{MANIFEST_SCHEMA}, run string").parquet(f"{base_dir}/manifests")
    return listed.join(broadcast_if_small(runs), (F.col("run") == F.col("_run")) & (F.col("seq") == F.col("_seq"))).drop("_seq", "_run")


def live_pages(spark: SparkSession, base_dir: str, status_table: str) -> DataFrame:
    """Rows of the live pages as they were written, as text, with `run`, `reg_dt`, `seq` and `file_name`."""
    live = live_manifest(spark, base_dir, status_table).where(F.col("page").isNotNull())
    live = live.select(F.col("run").alias("_run"), F.col("seq").cast("string").alias("_seq"), F.col("file_name").alias("_file"))
    pages = read_pages(spark, f"{base_dir}/pages")
    same = (F.col("run") == F.col("_run")) & (F.col("seq") == F.col("_seq")) & (F.col("file_name") == F.col("_file"))
    return pages.join(broadcast_if_small(live), same, "left_semi")
