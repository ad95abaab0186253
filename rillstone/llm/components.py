"""Connected components of an edge table by alternating large and small stars.

Each step joins every node's neighbours to the smallest of them, so that long chains shrink by about a half and hubs
never gather their neighbours in one row: only minima are aggregated. Each step is written to the shared folder, and so
are the minima before they meet the links again, since adaptive execution splits no join whose side is an aggregate on
the join's key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import discard, materialize


def both_ways(edges: DataFrame, small: bool) -> DataFrame:
    """The links of a step over edges (u, v), u > v: a small star looks at smaller neighbours only."""
    return edges if small else edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def smallest(both: DataFrame) -> DataFrame:
    """``u, m``: each node's smallest neighbour, or itself."""
    return both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def moved(both: DataFrame, least: DataFrame, small: bool) -> DataFrame:
    """The edges after a step. ``least`` has to be a written table: its join can then be split where a node is a hub."""
    near = both.join(least, "u")
    if small:  # all smaller neighbours and the node itself join the smallest
        new = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    else:  # all larger neighbours join the smallest
        new = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return new.where("u > v").distinct()


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One step, written; ``edges`` go."""
    both = both_ways(edges, small)
    least = materialize(smallest(both), "smallest")
    out = materialize(moved(both, least, small), "edges", instead=edges)
    discard(least)
    return out


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of all nodes with a link to another: the component is its smallest node.

    Null ends and self-links count as no link; repeated links don't matter; no links: an empty table.
    """
    high, low = F.greatest(a, b), F.least(a, b)
    now = materialize(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(high.alias("u"), low.alias("v")).where("u > v").distinct(), "edges")
    seen = None
    while True:
        now = _star(_star(now, small=False), small=True)
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sums == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = sums
