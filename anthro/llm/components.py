"""Connected components of a graph of links, by alternating large and small stars.

Every round is a group-by and a join over the links; nothing is collected but
two numbers.  A vertex with very many links is one row on one side of the join,
so a skewed partition can be split by the planner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anthro.llm.common import stage


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    if large:
        around = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = around.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``links`` (a, b: long vertices) to one row (vertex, root) per linked vertex; root is the least vertex."""
    def mark(x: DataFrame) -> tuple:
        return tuple(x.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = stage(links.where("a != b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).select("a", "b").distinct(), "links")
    seen = mark(now)
    for _ in range(rounds):
        if not seen[0]:
            break
        now = stage(_star(_star(now, True), False), "stars")
        before, seen = seen, mark(now)
        if before == seen:
            return now.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    if seen[0]:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    return roots
