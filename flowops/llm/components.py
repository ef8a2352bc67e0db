"""Connected components of a graph that is held in tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the component's smallest node) for all nodes of ``edges`` (``a``, ``b``).

    Every round hangs each node's neighbours on the smallest node around it, first the larger
    neighbours, then the smaller ones, until all hang on their root: about log n rounds.
    """
    state = cut_lineage(_distinct(edges), "edges")
    before = None
    while True:
        state = _large_star(state)
        state = cut_lineage(_small_star(state), "edges")
        # the same set of edges twice: every node hangs on its root
        mark = state.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if mark == before:
            break
        before = mark
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.where("b > a").join(stored(least, "least"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return cut_lineage(_distinct(moved), "edges")


def _small_star(edges: DataFrame) -> DataFrame:
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a")
    return _distinct(moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))))
