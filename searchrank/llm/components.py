"""Connected components by alternating star contractions.

Every round is two groupings and joins on the edge table, written to the
shared checkpoint folder, so lineage stays short and no group or edge list
reaches the driver.  The number of rounds grows with the logarithm of the
longest path, not with its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchrank.llm.common import stage


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    # every edge already points from the larger node a to the smaller node b
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` of longs -> ``(node, root)``, root the smallest node reachable.

    Self links are ignored and repeated links count once; rows with a null
    end are dropped (they link nothing).  Nodes without links do not
    appear.  No edges give an empty table.
    """
    e = stage(edges.where("a is not null and b is not null and a <> b")
              .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    last = None
    while True:
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == last or mark[0] == 0:
            break
        last = mark
        e = stage(_small_star(_large_star(e)), "edges")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
