"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..runtime import discard, written


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that a link names; ``root`` is the component's smallest node.

    Each round ties the larger neighbours of every node to its smallest neighbour, then
    the smaller ones, until nothing changes: O(log² n) rounds. A node's links are never
    gathered: minima are map-side aggregates, and the join back may split a hot node.
    Links with a null end are ignored. Rounds are written to the shared folder, so a
    lost executor repeats one round only.
    """
    edges = written(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        before, edges = edges, written(small.where("u != v").distinct(), "links")
        discard(before)
        reached = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if reached == state:
            break
        state = reached
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
