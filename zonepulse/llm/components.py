"""Connected components as DataFrame rounds of the large-star and small-star
operations (Kiveris et al., 2014). Nothing is collected; hubs go through
``attach_groups``, and every round is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.common import attach_groups, stored


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    return stored(pairs.groupBy("u").agg(F.min("v").alias("least"), F.count(F.lit(1)).alias("degree")), "star-least")


def _directed(pairs: DataFrame) -> DataFrame:
    """u > v, each pair once."""
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (u, v): the label is the
    smallest node of its component. Nodes may be of any ordered type."""
    now = stored(_directed(edges), "star-edges")
    seen = None
    while True:
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen or not mark[0]:
            break
        seen = mark
        # Large star: every larger neighbour of u moves to u's least one.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = attach_groups(both, _least_neighbour(both), ["u"], "degree").where("v > u")
        large = stored(_directed(large.select(F.col("v").alias("u"), F.least("u", "least").alias("v"))), "star-large")
        # Small star: u and its smaller neighbours move to the least of them.
        met = attach_groups(large, _least_neighbour(large), ["u"], "degree")
        small = met.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            met.select("u", F.col("least").alias("v"))
        )
        now = stored(_directed(small), "star-edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
