"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) for every node of ``links`` (``a``, ``b``, whole numbers).

    Alternates between linking a node's larger neighbours to the smallest one around it and a node's smaller
    neighbours to the smallest among them, until every node hangs on its component's smallest. The number of links
    never grows, and minima are taken on the map side, so a node with very many links is harmless. Every round is
    stored. Loops and repeated links do no harm; no links give no nodes.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    edges = cut_lineage(edges, "links")
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "links-around")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut_lineage(large, "links-large")
        least = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")), "links-below")
        others = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(least.select("u", F.col("m").alias("v")).unionByName(others).distinct(), "links")
        was, mark = mark, _mark(edges)
        if mark == was:
            roots = edges.select(F.col("v").alias("node")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                roots.select("node", F.col("node").alias("component"))
            )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
