"""Connected components of a graph of ids, by alternating stars; no part passes the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.llm.common import Workspace


def _nearest(links: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours."""
    return links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect larger neighbours of a node to the smallest of them all."""
    links = _both_ways(edges)
    joined = links.where("b > a").join(_nearest(links), "a")
    return joined.select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours to the smallest of these."""
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = _nearest(links)
    moved = links.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b")))


def _stars(edges: DataFrame) -> bool:
    """Whether each larger end of an edge has one neighbour, which is no larger end itself."""
    ends = F.explode(
        F.array(
            F.struct(F.col("a").alias("node"), F.lit(1).alias("larger")),
            F.struct(F.col("b").alias("node"), F.lit(0).alias("larger")),
        )
    )
    by_node = edges.select(ends.alias("end")).groupBy("end.node").agg(
        F.sum("end.larger").alias("larger"), F.min("end.larger").alias("least")
    )
    other = F.count_if((F.col("larger") > 1) | (F.col("larger") > F.col("least")))
    return by_node.agg(other).first()[0] == 0


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """``node, component`` (its smallest reachable node) of every node in ``edges`` (a, b).

    The edges are rewritten, round by round, until they are stars; rounds grow with the
    logarithm of the graph's size. Each round's edges are a table of ``work``.
    Nulls and loops are ignored.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = work.written(edges.where("a <> b").select(larger, smaller).distinct(), "edges")
    while not _stars(edges):
        edges = work.written(
            _small_star(_large_star(edges)).where("a <> b").distinct(), "edges"
        )
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
