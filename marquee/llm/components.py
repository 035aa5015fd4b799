"""Connected components of an edge table, as rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marquee.sources.scratch import keep

MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node that can be reached.

    Alternates the large-star and small-star steps: each node is tied to the least of its neighbours,
    which halves paths while the number of edges never grows. Minima are added up in each task first and
    the look-ups are plain equi-joins that the adaptive planner may split, so a node with very many
    neighbours is no single task's work. Every round is written to the shared folder. Only a count and
    a checksum of the edges come to the driver.
    """
    def tidy(e: DataFrame) -> DataFrame:
        return e.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = keep(tidy(edges.select("a", "b")), "edges")
    before = mark(now)
    for _ in range(MOST_ROUNDS):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        large = tidy(both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = keep(large, "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        now = keep(tidy(small), "edges")
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
