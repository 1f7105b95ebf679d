"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is a minimum per node and a join; its table is written to the shared folder, so lineage stays short and a
lost executor repeats little. The number of steps grows with the logarithm of a component's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.scratch import keep


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    arcs = _both_ways(links)
    least = arcs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return arcs.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of these."""
    arcs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = arcs.groupBy("u").agg(F.min("v").alias("m"))
    moved = arcs.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and component (its least node) for every node of links (a, b); links to itself and repeated ones do no harm."""
    now = keep(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    print_ = _mark(now)
    while True:
        now = keep(_small_star(_large_star(now)), "stars")
        mark = _mark(now)
        if mark == print_:
            break
        print_ = mark
    least = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(least)


def _mark(links: DataFrame) -> tuple:
    """Number and hash sum of the links."""
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
