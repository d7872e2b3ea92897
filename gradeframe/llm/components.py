"""Connected components of links between integer ids, by Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeframe.llm.common import release, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b; any order, repeats allowed).

    ``component`` is the smallest id reachable. Alternates two steps until nothing
    changes: every node links its larger neighbours to its smallest neighbour, then
    its smaller neighbours to the smallest one. Chains shrink at least
    geometrically in practice, each step is an aggregate (combined map-side) and a
    join that Spark may split on a hot node, and each round is written to the
    shared folder. Links with a NULL end or equal ends count for nothing; no links, no rows.
    """
    edges = stored(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "smallest")
        large = both.join(smallest, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u != v").distinct(), "large-star")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        after = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        same = after.count() == edges.count() and after.join(edges, ["u", "v"], "left_anti").isEmpty()
        release(edges, smallest, large, least)
        if same:
            break
        edges = after
    return after.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        after.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
