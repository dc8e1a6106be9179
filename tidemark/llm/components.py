"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage_lean


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the least v of each u."""
    return edges.join(edges.groupBy("u").agg(F.min("v").alias("least")), "u")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of ``edges`` (a, b).

    Large and small stars in turn: every node hands its larger neighbours, then its smaller ones, to the
    least node it knows, until each component is one star. Each round is staged; minima are combined
    before they are shuffled, and nothing is gathered per node, so a node may have any number of edges.
    """
    edges = stage_lean(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.least("least", "u").alias("v")).distinct()
        small = _with_least(stage_lean(large))
        kept = small.select(F.col("u").alias("a"), F.col("least").alias("b"))
        moved = small.filter("v <> least").select(F.col("v").alias("a"), F.col("least").alias("b"))
        edges = stage_lean(kept.unionByName(moved).distinct())
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
