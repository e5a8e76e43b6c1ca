"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import cut


def _towards_minimum(links: DataFrame) -> DataFrame:
    """Each (u, v) of ``links`` with m, the least of u and u's partners."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("u2"), F.least("u", "m").alias("m"))
    return links.join(least, F.col("u") == F.col("u2")).drop("u2")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the component's least node.

    Self loops and repeated edges are allowed; edges with a null end link nothing; no edges give no row; other columns are left out.  A round's minima are pre-aggregated before the
    shuffle and joined back, so that the join of a node with very many partners can be split;
    no partner list is ever gathered.  Each round is written to the shared folder.
    """
    links = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _towards_minimum(large.where("u > v").distinct())
        star = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        links = cut(star.select("e.*").where("u > v").distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
