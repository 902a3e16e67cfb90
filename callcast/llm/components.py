"""Connected components of an edge table, in Spark.

Alternating large-star and small-star rounds (each a grouped minimum and a
join) turn any graph into stars around the smallest node of each component in
a logarithmic number of rounds.  The minimum is taken before the join with
map-side combining, so a hub with very many edges is not gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callcast.session import materialize


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(low.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); root is the component's smallest node."""
    e = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = None
    while True:
        now = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if now == mark or not now.n:
            break
        mark = now
        e = materialize(_small_star(_large_star(e)), name)
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
