"""Connected components of links by alternating large-star and small-star steps (Kiveris et al., 2014).

Every step is a grouped minimum (combined in each task before the shuffle) and an equi-join that adaptive execution may split, so
no node's neighbours are ever gathered. Steps are checkpointed in the shared folder.
"""
from pyspark.sql import DataFrame, functions as F

from lectern.session import cut_lineage


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every node that has a link; component is the smallest id reachable. Null ends link nothing."""
    edges = cut_lineage(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    before = _digest(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = cut_lineage(large.join(small, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .union(small.select("u", F.col("m").alias("v"))).distinct())
        after = _digest(edges)
        if after == before:
            break
        before = after
    return (edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component")
            .union(edges.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))))
