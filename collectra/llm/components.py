"""Connected components of an edge table, by alternating large and small stars.

Edges stay a distributed table all the time; each round is written to the
shared folder.  In a round every node hands its larger (large star) or smaller
(small star) neighbours to its smallest one, so paths shorten by a constant
factor and the edges end as stars around the smallest node of a component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collectra.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges``: (u, v) with u < v.  Returns edges in the same form."""
    spark = edges.sparkSession
    if large:  # every node's view of all its neighbours
        seen = edges.select(F.col("u").alias("n"), F.col("v").alias("o")).union(edges.select(F.col("v"), F.col("u")))
    else:
        seen = edges.select(F.col("v").alias("n"), F.col("u").alias("o"))
    least = written(spark, seen.groupBy("n").agg(F.least(F.min("o"), F.col("n")).alias("m")), "least")
    # both sides are plain scans, so the rows of a hot node can be split
    joined = seen.join(least, "n")
    moved = joined.where(F.col("o") > F.col("n")) if large else joined
    pairs = moved.select(F.col("m").alias("u"), F.col("o").alias("v"))
    if not large:  # the node itself hangs on its smallest neighbour too
        pairs = pairs.union(least.select(F.col("m"), F.col("n")))
    return pairs.where(F.col("u") < F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that ``node`` reaches, for every node on an edge."""
    spark = edges.sparkSession
    edges = written(spark, edges, "edges")
    while True:
        after = written(spark, _star(written(spark, _star(edges, True), "large"), False), "small")
        # all stars: no node is both a centre and a leaf, and no leaf has two centres
        wrong = after.groupBy("v").agg(F.count("*").alias("n")).where("n > 1").select("v") \
            .union(after.select("u").distinct().join(after.select(F.col("v").alias("u")), "u", "left_semi"))
        if wrong.isEmpty():
            break
        edges = after
    return after.select(F.col("v").alias("node"), F.col("u").alias("root")) \
        .union(after.select("u", F.col("u").alias("r")).distinct())
