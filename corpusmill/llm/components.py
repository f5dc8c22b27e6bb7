"""Connected components of a graph given by its edges, without any group in one task or the driver.

Alternates the large-star and small-star steps: every node hands its smallest neighbour on to its
larger neighbours, then to its smaller ones, until all edges point at roots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill import staging
from corpusmill.llm import skew


def _stars(edges: DataFrame) -> bool:
    """Whether every ``a`` has one ``b`` and no ``b`` is an ``a``."""
    parents = edges.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("up"))
    roots = edges.select(F.col("b").alias("node"), F.lit(0).alias("up"))
    ends = parents.unionByName(roots).groupBy("node").agg(F.max("up").alias("most"), F.min("up").alias("least"))
    return ends.where((F.col("most") > 1) | (F.col("most") > 0) & (F.col("least") == 0)).isEmpty()


def _step(pairs: DataFrame, label: str) -> DataFrame:
    """``pairs`` ``(u, v)`` staged, with the smallest ``m`` among ``u`` and all its ``v``."""
    pairs = staging.stage(pairs, f"components-{label}")
    smallest = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("n"))
    facts = staging.stage(smallest, f"components-{label}-smallest")
    total = facts.agg(F.sum("n")).first()[0] or 0
    return skew.attach(pairs, facts, "u", total, "inner")


def connected(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable, for every node of ``edges`` (``a, b``) that is
    not a root itself. Loops and repeated edges do not matter; edges with a null are left out."""
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = edges.where(F.col("a") != F.col("b")).select(larger.alias("a"), smaller.alias("b")).distinct()
    edges = staging.stage(edges, "components-edges")
    while not _stars(edges):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = _step(both, "large").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _step(large.distinct(), "small")
        linked = small.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            small.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
        edges = staging.stage(linked.where(F.col("a") != F.col("b")).distinct(), "components-edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
