"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.tables import stored

MAX_ROUNDS = 60
#: Edges of a written file; a round's edges are few next to the texts and should not come in many small files.
FILE_EDGES = 500_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node goes to the smallest of the node and its neighbours.

    The join is on another key than the minima are counted by, so it is dealt out anew and the many edges of one node can be
    split among tasks.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    key = F.col("a").bitwiseXOR(F.lit(1)).alias("k")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(key, F.least("a", "m").alias("m"))
    return both.filter("b > a").select(key, "b").join(least, "k").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them. After a large star, what a node has many of are larger
    neighbours, so the smaller ones of a node can meet in one task."""
    least = edges.withColumn("m", F.min("b").over(Window.partitionBy("a")))
    # the row of the smallest neighbour carries the node itself, the other rows their neighbour
    return least.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()


def _unsettled(edges: DataFrame) -> int:
    """Nodes that have two smaller neighbours, or both a smaller and a larger one: none are left when all edges form stars."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    seen = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.filter("up > 1 or up > 0 and down > 0").count()


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (smallest id reachable) of every node of ``edges`` (columns ``a`` and ``b``, integers).

    Loops, repeated and reversed edges and rows with a null change nothing; no edges give no rows. The neighbours of a node
    are never gathered: each round takes minima, which combine before the shuffle, and joins them back. A round's edges are
    written to the shared folder. Rounds grow with the logarithm of the longest path.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    files = 1 + now.count() // FILE_EDGES
    for _ in range(MAX_ROUNDS):
        if not _unsettled(now):
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(now.select("b", F.col("b").alias("c")).distinct())
        now = stored(_small_star(_large_star(now)).coalesce(max(files, 8)))
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
