"""Connected components of a table of links, by alternating stars; nothing comes to the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewh.llm.common import drop_stored, stored


def components(links: DataFrame) -> DataFrame:
    """(v, component) for each vertex of links (a, b); component is the smallest vertex reachable.

    A large star hangs all larger neighbours of a vertex on its smallest neighbour, a small star the
    rest; each keeps the components as they are.  It ends when every vertex hangs on its component's
    smallest one.  Sums of a vertex are partial aggregates; the joins are sort-merge joins that Spark
    splits at a vertex of many links.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("p"))
                   .filter("u <> p").distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("p").alias("u"), F.col("u").alias("p")))
        least = both.groupBy("u").agg(F.least(F.min("p"), F.col("u")).alias("m"))
        large = (both.join(least, "u").filter("p > u").select(F.col("p").alias("u"), F.col("m").alias("p")))
        large = stored(large.distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("p").alias("m"))
        hung = large.join(low, "u").select(F.col("p").alias("u"), F.col("m").alias("p"))
        small = stored(hung.unionByName(low.select("u", F.col("m").alias("p"))).filter("u <> p").distinct(), "small-star")
        drop_stored(large)
        # done: no vertex that others hang on hangs on another, and none hangs on two
        parents = small.select(F.col("p").alias("u")).distinct()
        done = (small.join(parents, "u", "left_semi").isEmpty()
                and small.groupBy("u").count().filter("count > 1").isEmpty())
        drop_stored(edges)
        edges = small
        if done:
            return (small.select(F.col("u").alias("v"), F.col("p").alias("component"))
                    .unionByName(small.select(F.col("p").alias("v"), F.col("p").alias("component")).distinct()))
