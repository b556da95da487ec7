"""Connected components by alternating large-star and small-star.

Edges are pairs (a, b) with a > b. Large-star links every larger neighbour of a node to the node's smallest neighbour,
small-star every smaller one; both keep components whole and after a few rounds each is a star about its smallest node.
Smallest neighbours come from an aggregation (with partial sums before the shuffle) that is joined back, so a node with
very many edges is never gathered; such joins are split by Spark's skew handling. Each round is cut by a written table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm import common


def _canonical(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.col("b").alias("u"), F.least("a", "b").alias("m")).unionByName(e.select(F.col("a").alias("u"), F.col("b").alias("m")))
    least = both.groupBy("u").agg(F.min("m").alias("m"))
    return e.join(least, e["b"] == least["u"]).select(F.col("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    rest = e.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(rest)


def components(edges: DataFrame) -> DataFrame:
    """node, component for each node of edges (a, b: of one orderable type) that isn't the smallest of its component."""
    spark = edges.sparkSession

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first())

    e, path = common.saved(_canonical(edges), "edges")
    now = state(e)
    while now[0]:
        following = reduce(lambda x, f: _canonical(f(x)), (_large_star, _small_star), e)
        old = path
        e, path = common.saved(following, "edges")
        common.remove(spark, old)
        was, now = now, state(e)
        if was == now:
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
