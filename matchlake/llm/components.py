"""Connected components of a table of edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable): one row per node of (a, b) edges.

    Each step hangs the neighbours of a node under the smallest of them. A node with very many neighbours is one
    row per task before the shuffle, and its edges stay where adaptive execution can split them. Every round is written
    to the shared folder; rounds grow with the logarithm of the longest chain.
    """
    links = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        links = _hang(both, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), F.col("v") > F.col("u"))
        links = stored(_hang(links, links.groupBy("u").agg(F.min("v").alias("m")), F.lit(True), own=True), "edges")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component")))


def _hang(links: DataFrame, smallest: DataFrame, which, own: bool = False) -> DataFrame:
    """Edges from the neighbours of a node, and from the node itself if ``own``, to its smallest neighbour."""
    joined = links.join(smallest, "u")
    out = joined.filter(which & (F.col("v") != F.col("m"))).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if own:
        out = out.unionAll(smallest.select("u", F.col("m").alias("v")))
    return out.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
