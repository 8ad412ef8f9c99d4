"""Connected components by alternating large-star and small-star rounds.

Every round is two joins on node ids; the number of rounds is logarithmic in
practice. Links and labels stay distributed: only a count of the nodes that
are not yet linked to their smallest node alone reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.common import keep, keep_counted


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(node, comp)`` for every node of an edge, where
    ``comp`` is the smallest node reachable. Self-loops and repeats are fine;
    nodes without an edge to another node are not returned."""
    e = keep(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
             .filter("hi <> lo").distinct())
    while True:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select("lo", "hi"))
        # the minima are kept apart, so that both join sides are plain shuffles
        # and AQE can split the partition of a node with very many links
        least, n = keep_counted(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("links"))
                                .select("u", F.least("u", "m").alias("m"), "links"),
                                inner=F.count_if((F.col("m") < F.col("u")) & (F.col("links") > 1)))
        if not n["inner"]:      # whoever has a smaller neighbour has no other: stars about the smallest nodes
            break
        large = keep(both.join(least.drop("links"), "u").filter("v > u")
                     .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        low = keep(large.groupBy("hi").agg(F.min("lo").alias("m")))
        e = keep(large.join(low, "hi").filter("lo <> m")
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .union(low).distinct())
    nodes = e.select(F.col("hi").alias("node"), F.col("lo").alias("comp"))
    return nodes.union(e.select("lo", "lo").distinct())
