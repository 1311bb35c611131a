"""Connected components of a table of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every a of edges(a > b) has one b, which is no a itself: then b is the smallest node of its component."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    open_ = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up > 0 and down > 0")
    return open_.count() == 0


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node) for every node of edges(a, b) but the smallest of each component.

    Loops and repeated edges change nothing; without edges there are no rows. Each round is stored; a hub's edges are
    handled by its minimum, never gathered. Converges in about log(diameter) rounds, none for edges that are stars.
    """
    state = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "components")
    while not _are_stars(state):
        state = saved(_small_star(_large_star(state)), "components")
    return state.select(F.col("a").alias("node"), F.col("b").alias("component"))


def rejoined(joined: DataFrame, more: DataFrame) -> DataFrame:
    """The components joined(node, component), further joined by more(component, larger component's root), as stored rows.

    more holds components() of edges between components of joined, which are named by their smallest nodes.
    """
    roots = more.toDF("component", "root")
    moved = joined.join(roots, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return saved(moved.unionByName(more), "components")
