"""Connected components of links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame, folder: str) -> DataFrame:
    """``node, label`` of every node in ``links`` (``a``, ``b``): the least node it reaches.

    Alternates the large-star and small-star steps, which need about a logarithm of the longest
    path in rounds and never bring a node's links together: each step is a minimum per
    node, combined in the map tasks, and a join. Every round is written below ``folder``, a
    place all executors share.
    """
    spark = links.sparkSession

    def keep(frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def both_ways(edges: DataFrame) -> DataFrame:
        return edges.union(edges.select("b", "a"))

    def star(rows: DataFrame) -> DataFrame:
        """Rows (a, b) with the least node among a and all its b."""
        least = rows.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        return rows.join(least.withColumnRenamed("a", "_a"), F.col("a") == F.col("_a"))

    def larger_first(edges: DataFrame) -> DataFrame:
        a, b = F.greatest("a", "b"), F.least("a", "b")
        return edges.filter(F.col("a") != F.col("b")).select(a.alias("a"), b.alias("b")).distinct()

    def digest(edges: DataFrame):
        return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()

    edges = keep(larger_first(links.select("a", "b")), "round-0")
    before, number = digest(edges), 0
    while before[0]:
        number += 1
        large = star(both_ways(edges)).filter(F.col("b") > F.col("a"))
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = keep(larger_first(large), f"large-{number}")
        small = star(edges)
        pulled = small.select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = small.select("a", F.col("m").alias("b"))
        edges = keep(larger_first(pulled.union(own)), f"round-{number}")
        after = digest(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return members.union(members.select("label", "label").distinct())
