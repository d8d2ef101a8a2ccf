"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import written
from daybook.operators.joins import join_on_key


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return join_on_key(both.where("b > a"), least, "a", "inner").where("b <> m").select(
        F.col("b").alias("a"), F.col("m").alias("b")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = join_on_key(down, least, "a", "inner").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """`node, root` of every node of `edges(a, b)` but the roots; the root is the least node.

    Each round is written to the shared folder. Only two numbers of a round
    reach the driver. The rounds grow as the logarithm of the longest path.
    A node of very many edges is split by adaptive execution, as `join_on_key`
    shuffles both sides of its joins for them. No edges give no rows.
    """
    now = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(),
        "components",
    )
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or tuple(state) == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(state)
        now = written(_small_star(_large_star(now).distinct()).distinct(), "components")
