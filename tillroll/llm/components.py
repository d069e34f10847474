"""Connected components of a graph given as edges, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import settle


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) for every node of ``edges``.

    ``edges`` has columns ``a`` and ``b`` (long), about ``rows`` of them.  Large-star and small-star steps
    (every node hands its larger, then its smaller neighbours to its smallest one)
    end after a logarithmic number of rounds in stars around the roots.  A hub's
    neighbours are never gathered: its minimum is a partial aggregate, joined back.
    """
    low, high = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    now = settle(edges.where("a <> b").select(high, low).distinct(), "edges", rows)
    was, state = None, _state(now)
    while state != was and state[0]:
        n = state[0]
        # Large star: the larger neighbours of a node move to its smallest neighbour.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = settle(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "star", n)
        now = settle(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "edges", n)
        # Small star: so do its smaller neighbours, and the node itself.
        least = settle(now.groupBy("a").agg(F.min("b").alias("m")), "star", n)
        moved = now.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = settle(moved.unionByName(least.withColumnRenamed("m", "b")).distinct(), "edges", n)
        was, state = state, _state(now)
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
