"""Connected components of a link table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spineloom.llm.tables import Tables


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest node reachable. No links: no rows.

    Alternates large and small stars, so that the number of passes follows the logarithm of the longest chain. Nulls,
    self-links and repeated links do no harm. Each pass is written to the shared folder. Earlier labels may be given as
    links, which is quicker than the links they came from.
    """
    stored = Tables(links.sparkSession, "components")
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where((F.col("a") != F.col("b")))
        .distinct()
    )
    while True:
        # Every edge points down to the root of a star: nothing is left to do.
        roots = edges.select(F.col("b").alias("a")).distinct()
        several = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
        unsettled = edges.join(roots, "a", "left_semi").select("a").union(several)
        if not unsettled.take(1):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                roots.select(F.col("a").alias("node"), F.col("a").alias("label"))
            )
        around = _both_ways(edges)
        least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root"))
        large = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        large = stored(large.where("a != b").distinct())
        lowest = large.groupBy("a").agg(F.min("b").alias("root"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).where("a != b")
        edges = stored(small.union(lowest.select("a", F.col("root").alias("b"))).distinct())
