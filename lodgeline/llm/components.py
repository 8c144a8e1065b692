"""Connected components of an edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeline.llm.common import staged


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end, without loops."""
    return (
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )


def _large_star(e: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least node around it."""
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return both.join(least, F.col("u") == F.col("c")).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
    others = e.join(least, F.col("u") == F.col("c")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return others.union(least.select(F.col("c").alias("a"), F.col("m").alias("b")))


def _settled(e: DataFrame) -> bool:
    """Whether every edge leads straight to the least node: one edge a node, and none from the node it leads to."""
    several = e.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    onward = e.join(e.select(F.col("u").alias("c")), F.col("v") == F.col("c"), "left_semi").select("u")
    return several.union(onward).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """`node` and `component` (least node reachable) of every node but the least of each component.

    `edges` has long columns a and b. Every round ends in a written table; rounds stop when all edges lead straight to
    the least node. Stars need one round, a path of n edges about log n. Aggregations are minima, which combine before
    the shuffle, and joins are plain equi-joins, which Spark splits where a node has very many edges.
    """
    e = staged(_directed(edges), "edges")
    while not _settled(e):
        e = staged(_directed(_large_star(e)), "edges")
        e = staged(_directed(_small_star(e)), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
