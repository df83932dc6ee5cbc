"""Connected components by alternating large-star and small-star.

Every round is a grouped minimum and a join back, written to the shared folder
before the next one, so neither the driver nor a task ever holds a component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import settle, spread_join


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Two numbers that stay the same once a round changes nothing."""
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
    return spread_join(both, least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked with the smallest of them; edges run from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = spread_join(edges, least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where(
        "u <> v"
    ).distinct()


def components(edges: DataFrame) -> DataFrame:
    """For edges (u, v): every node and the smallest node of its component (node, component).

    Loops and repeated edges are ignored; no edges give no rows.
    """
    now = settle(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    mark = _mark(now)
    while mark[0]:
        now = settle(_small_star(_large_star(now)), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    # stars: every edge leads from a node to the smallest one
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
