"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayload.llm.common import Files, look_up


def _star(edges: DataFrame, count: int, large: bool) -> DataFrame:
    """One operation: neighbours of each node are linked to the least of them all, the node included.

    ``large`` moves neighbours above the node, otherwise those below and the
    node itself. Nodes with very many neighbours are looked up by broadcast.
    """
    turned = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    near = sides.unionByName(turned) if large else sides
    least = near.groupBy("u").agg(F.least(F.min("v"), "u").alias("m"), F.count("*").alias("n"))
    found = look_up(near, least, "u", "n", count * (2 if large else 1))
    if large:
        moved = found.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = found.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.where("a > b").distinct()


def _stars_only(edges: DataFrame) -> bool:
    """Whether each node is either a centre or a leaf of one centre."""
    roles = edges.select(F.col("a").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("centre"))
    )
    found = roles.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    return not found.where("leaf + centre > 1").take(1)


def components(links: DataFrame, files: Files) -> DataFrame:
    """``node`` and ``root``, the least node it is connected to, for each node of ``links`` (a, b longs).

    Roots have no row of their own. Large stars and small stars take turns until
    only stars are left; the number of rounds grows with the logarithm of the
    size. Nodes linked to themselves and repeated links change nothing.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = files.write(ordered, "links")
    turn = 0
    while not _stars_only(edges):
        edges = files.write(_star(edges, edges.count(), True), f"large{turn}")
        edges = files.write(_star(edges, edges.count(), False), f"small{turn}")
        turn += 1
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
