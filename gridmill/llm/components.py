"""Connected components by alternating large and small stars."""

from pyspark.sql import functions as F

from gridmill.session import stored


def _sum(edges):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges):
    """(u, v) with v the least node of the component of u, for every u above it.

    Each round hangs the larger neighbours of a node below its least one (large
    star), then the smaller ones (small star), until nothing changes: rounds
    grow with the logarithm of the longest path. Rounds are written, so a lost
    executor costs no more than the round; hubs are split as skewed joins.
    """
    edges = stored(edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).filter("u <> v").distinct(), "edges")
    seen = _sum(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large.filter("u <> v"), "edges")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(down.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        )
        edges = stored(small, "edges")
        now = _sum(edges)
        if now == seen:
            break
        seen = now
    return edges
