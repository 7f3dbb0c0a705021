"""Connected components of an edge table by alternating star contractions.

Each round first hangs every node's larger neighbours on its smallest
neighbour, then every node's smaller neighbours on the smallest of them; the
round's edges are written to the shared checkpoint folder. Rounds end when the
edges stop changing, after about log n rounds. Neighbours are never collected:
a round is grouped minima (combined before the shuffle), written, and plain
equi-joins with them, which the adaptive planner can split at a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.staging import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = staged(edges.sparkSession, both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return (both.join(least, "a").filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = staged(edges.sparkSession, edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(spark: SparkSession, edges: DataFrame, a: str, b: str, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge; root is the component's smallest
    node. Null ends and loops are ignored."""
    now = staged(spark, edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                 .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                 .select("a", "b").distinct(), "edges")
    state = _state(now)
    for _ in range(most_rounds):
        now = staged(spark, _small_star(staged(spark, _large_star(now), "edges")), "edges")
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
