"""Connected components of an edge table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import written

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long); root is the smallest node reachable.

    Alternates two steps until nothing changes. Large star: every node hands its larger
    neighbours to its smallest neighbour. Small star: every node hands its smaller neighbours
    to the smallest of them. Each step is one aggregate (combined before the shuffle, so a hub
    costs one row per task) and one join, and its edges are written to the shared folder.
    Loops and repeated edges are harmless; an empty table gives an empty result.
    """
    cur = edges.select("a", "b").where("a != b")
    cur = written(cur.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    for _ in range(MAX_ROUNDS):
        both = cur.unionAll(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct())
        large = written(large, "cc")
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        joined = large.join(low, "a")
        small = (joined.select("a", F.col("m").alias("b"))
                 .unionAll(joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")))
                 .distinct())
        nxt = written(small, "cc")
        # finished when every node has one edge and its target has none: a forest of stars
        many = nxt.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("b").alias("b"))
        open_ = many.where("n > 1").select("a").limit(1).count()
        if not open_:
            chained = nxt.join(nxt.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()
            if not chained:
                return (nxt.select(F.col("a").alias("node"), F.col("b").alias("root"))
                        .unionAll(nxt.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
        cur = nxt
    raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
