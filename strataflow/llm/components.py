"""Connected components of a graph given by its links.

Each step names for every node its smallest neighbour, follows these names a few times and
contracts the graph by them: a node merges with one that is smaller, so at least half of the
nodes that have links go with each full step, and the links of a group shrink to none.
Names are minima with map-side combine, and links are joined by node only, so a node with
many links is split like any skewed join. Nothing is gathered per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.session import stage

FOLLOWED = 3


def _distinct_links(links: DataFrame) -> DataFrame:
    """Links with the smaller node first, once each, without loops."""
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.where("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, for every node of ``links(a, b)``."""
    links = stage(_distinct_links(links))
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    found = nodes.withColumn("root", F.col("node"))
    while not links.isEmpty():
        ways = links.select("a", "b").union(links.select("b", "a"))
        names = stage(
            ways.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("name"))
        )
        named = names
        for _ in range(FOLLOWED):
            after = names.select(F.col("node").alias("name"), F.col("name").alias("next"))
            named = named.join(after, "name").select("node", F.col("next").alias("name"))
        named = stage(named)
        of_root = named.select(F.col("node").alias("root"), "name")
        found = stage(
            found.join(of_root, "root", "left").select("node", F.coalesce("name", "root").alias("root"))
        )
        for end in ("a", "b"):
            of_end = named.select(F.col("node").alias(end), "name")
            other = "b" if end == "a" else "a"
            links = links.join(of_end, end).select(F.col("name").alias(end), other)
        links = stage(_distinct_links(links))
    return found
