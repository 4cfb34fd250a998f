"""Connected components of a table of links."""

from pyspark.sql import DataFrame, functions as F

from risklake.operators.stage import stage


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): the smallest id that it reaches.

    Large-star and small-star steps in turn, until only stars around the smallest ids are left. Each step hangs ids on
    the smallest neighbour found by an aggregate, so that an id with very many links is never gathered in one place.
    Every round is written, which cuts the lineage.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that the join has two plain sides, and adaptive execution can split an id with very many links
        least = stage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small_least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = small_least.select("u", F.col("m").alias("v"))
        edges = stage(hung.unionByName(own).distinct(), "links")
        # stars are left if nothing that something hangs on hangs itself, and everything hangs once
        inner = edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").limit(1)
        twice = edges.groupBy("u").count().where("count > 1").select("u", "u").toDF("u", "v").limit(1)
        if inner.select("u", "v").unionByName(twice).isEmpty():
            break
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return stage(edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots), "components")
