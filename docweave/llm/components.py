"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docweave.llm import common

MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _stars(pairs: DataFrame, mine: DataFrame) -> DataFrame:
    """Each b of a pair, and each a, linked to the least node around a; minima are combined before the shuffle."""
    joined = pairs.join(mine, "a")
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of `edges` (a, b: long); a component is named by its least node.

    Links that touch one node often are combined before shuffles and split by adaptive execution. Each round is written,
    so lineage stays short. Links from a node to itself and repeated links do no harm; no links give no rows.
    """
    edges = common.written(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links"
    )
    before = None
    for _ in range(MAX_ROUNDS):
        near = _both_ways(edges)
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = _stars(near.where("b > a"), least).where("a != b").distinct()
        # Here a > b: every node is linked to smaller ones only; a and all of them get the least.
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        links = _stars(large, least).unionByName(least.select("a", F.col("least").alias("b")))
        edges = common.written(links.where("a != b").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
