"""Size checks for everything that is broadcast or put into a plan as a literal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, functions as F

from docweave.scratch import written_table

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
PLAN_ROWS = 4_096
#: Stored tables up to this size are read again instead of being written once more.
UNWRITTEN_BYTES = 1024 * 1024
#: Texts of a partition whose rows repeat them. A Parquet file keeps each text once if the different ones fit a
#: dictionary page of 1 MB; the rest is room for partitions that get more than their share.
REPEATED_BYTES = 512 * 1024


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure rows and bytes of `df` in one distributed pass; only the two sums are collected."""
    measured = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("n_bytes"),
    ).first()
    return measured.n <= max_rows and measured.n_bytes <= max_bytes


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Mark `df` for broadcast if it was measured small; else Spark shuffles and splits skewed keys."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def rows_if_small(df: DataFrame, max_rows: int = PLAN_ROWS) -> list[Row] | None:
    """The rows of a small dictionary, or None when it holds more than `max_rows`."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def computed_once(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """`df`, written to a table unless it is a literal or a small stored table.

    What is measured and then used is otherwise computed each time, and its size in the plan is a guess; a written
    table is read again at the cost of its files.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() == "Project":
        plan = plan.child()
    kind = plan.nodeName()
    stored = kind.startswith("LogicalRelation") or kind.startswith("Relation")
    if kind == "LocalRelation" or (stored and int(str(plan.stats().sizeInBytes())) <= UNWRITTEN_BYTES):
        return df
    return written_table(df, name, paths)


def dealt_by_bytes(df: DataFrame, names: Sequence[str], max_bytes: int = REPEATED_BYTES) -> DataFrame:
    """`df` dealt to so many partitions that each column of `names` has about `max_bytes` in one.

    For rows that are exploded next and repeat these columns: written as Parquet, a repeated text then takes a number in
    a dictionary instead of its bytes. The columns are measured in one distributed pass.
    """
    sizes = [F.sum(F.octet_length(F.col(name).cast("string"))).alias(f"n{i}") for i, name in enumerate(names)]
    largest = max((n or 0 for n in df.agg(*sizes).first()), default=0) if sizes else 0
    return df.repartition(max(-(-largest // max_bytes), df.sparkSession.sparkContext.defaultParallelism))
