"""Connected components by alternating star operations, on edges of any number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.session import BROADCAST_ROWS, freeze


def _in_one_piece(df: DataFrame, rows: int) -> DataFrame:
    """A table of few rows as one partition, which joins and groups without a shuffle; others as they are."""
    return df.coalesce(1) if rows <= BROADCAST_ROWS else df


def _digest(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge to another node; component is the smallest node reachable.

    Each round links the larger neighbours of a node to its smallest neighbour,
    then the smaller ones; the rounds grow with the logarithm of the nodes.
    Edges with a null end and loops are left out.  Each round is checkpointed.
    Up to ``BROADCAST_ROWS`` edges, counted in each round, are worked on in one
    task without shuffles; more of them are shuffled.
    """
    pairs = edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"), F.col(a).isNotNull().alias("_a"), F.col(b).isNotNull().alias("_b"))
    now = freeze(pairs.filter("_a AND _b AND u <> v").select("u", "v").distinct())
    before = None
    while (after := _digest(now)) != before:
        before = after
        now = _in_one_piece(now, after[0])
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("u"), "v").filter("u <> v").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("m").alias("u"), F.col("u").alias("v")).filter("u <> v")
        now = freeze(small.unionByName(low.select(F.col("m").alias("u"), "v")).distinct())
    stars = now.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return stars.unionByName(now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
