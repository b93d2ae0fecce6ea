"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from smogline.session import pin_table


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): each node that has an edge and the smallest node it can reach.

    Alternating large-star and small-star steps. Every step is a grouped minimum
    and a join on nodes, written as a table in the shared folder so that no
    lineage grows; a node's neighbours never meet in one cell. The number of
    rounds grows with the logarithm of the number of nodes. Each round sends one number
    to the driver: whether anything changed. Null ends are ignored.
    """
    links = pin_table(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
                      .filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct(), "links")
    while True:
        # large star: each node's larger neighbours go to its smallest neighbour (or itself)
        both = links.union(links.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        large = pin_table(large, "links")
        # small star: each node and its smaller neighbours go to the smallest of them
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                 .union(least.select("u", "m").toDF("u", "v")).distinct())
        small = pin_table(small, "links")
        same = small.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        was = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        links = small
        if same == was:
            break
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
