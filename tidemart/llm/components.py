"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.shared import saved


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) links to (node, root): the root is the smallest node of its component, which
    has at least two nodes.  Each round links the neighbours of every node to the
    smallest of them; the links end as stars.  No group is ever collected."""
    edges = saved(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                  .filter("hi <> lo").distinct(), "links")
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")),
                        F.count_distinct("hi")).first()
        # each node hangs on one smaller node, and the last round changed nothing
        if now[:2] == mark or now[0] == 0:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
                edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
        mark = now[:2]
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u"), F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, "u")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least, "hi").filter("lo <> m")
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .unionByName(least.select("hi", F.col("m").alias("lo"))).distinct())
        edges = saved(small, "links")
