"""Connected components of links, by large-star and small-star rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagement_lake.llm.store import given_back, written


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the (a, b) links; a component is named by its least node.

    Each round points every node nearer to the least of its neighbours, until nothing changes. No
    round gathers a node's neighbours: only their minimum is aggregated and joined back.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = written(edges, "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        turned = written(small, "links")
        given_back(edges)
        edges = turned
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    groups = written(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots), "groups")
    given_back(edges)
    return groups


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).head())
