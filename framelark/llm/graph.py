"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.llm.common import checkpointed, emptied, left_join_by_key, long_key, own_tables, written


def _lowest(links: DataFrame) -> DataFrame:
    """The smallest b of each a, and how many links it has."""
    return checkpointed(links.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")))


def _with_lowest(links: DataFrame, low: DataFrame) -> DataFrame:
    """links with m of their a. The links of a hub stay where they are, and its m goes to them."""
    return left_join_by_key(links.withColumn("key", long_key(F.col("a"))), low.select(long_key(F.col("a")).alias("key"), "m", "n"), "key", "n")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    met = _with_lowest(both.filter("b > a"), _lowest(both))
    return met.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = _lowest(edges)
    others = _with_lowest(edges, low).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b) that isn't its component's smallest node; root is that smallest node.

    Each round, links move to the smallest neighbour, so paths shorten and hubs appear. A hub's links aren't gathered: only
    one minimum for each node and task is shuffled for it, and it is broadcast to them. Rounds are about the logarithm of
    the longest path. Only a count and a checksum come to the driver. Nulls aren't links."""
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    with own_tables() as own:
        now, before = written(now, "links"), None
        while True:
            seen = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
            if tuple(seen) == before or not seen[0]:
                return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            before = tuple(seen)
            # a table, as a checkpoint keeps its plan's estimated size, which joins multiply from round to round
            now = written(_small_star(checkpointed(_large_star(now))), "links")
            emptied(now.sparkSession, own, now)
