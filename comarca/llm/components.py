"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comarca.llm.common import staged

MOST_ROUNDS = 60


def connected_components(links: DataFrame) -> DataFrame:
    """The smallest node that can be reached from each node that has a link. Runs jobs.

    ``links`` has long columns a and b; columns of the result: node, component, stored. Every step is a
    minimum per node, partially aggregated, and a join that may split hot nodes; tables are
    written between steps. Links of a node to itself are left out.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = staged(edges.where("u > v").distinct(), "edges")
    seen = None
    for _ in range(MOST_ROUNDS):
        # Large star: a node's larger neighbours go to the smallest node around it.
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        # Small star: a node and its smaller neighbours go to the smallest of these.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m"))
        edges = staged(small.where("u > v").distinct(), "edges")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components still change after {MOST_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return staged(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots), "components")
