"""Joins that stay even when one key holds a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill import staging

#: A key is hot if it holds more than one row in so many. No more keys than this can be hot.
HOT_PARTS = 1000


def attach(rows: DataFrame, facts: DataFrame, key: str, total: int, how: str = "left") -> DataFrame:
    """``rows`` joined with ``facts`` (one row per key, ``n`` rows have it; ``n`` is dropped).

    Facts of hot keys are broadcast, at most ``HOT_PARTS`` of them as their counts add up to
    ``total``, so that rows of a hot key stay where they are; the others meet in a shuffle. Both
    inputs are read twice and should be staged. ``how`` is ``left`` or ``inner``.
    """
    is_hot = F.col("n") * HOT_PARTS > F.lit(max(total, HOT_PARTS))
    hot = facts.where(is_hot).drop("n")
    near = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return near.unionByName(rest.join(facts.where(~is_hot).drop("n"), key, how))


#: Rows of one key that meet its facts together, about.
TOGETHER = 500


def deal(rows: DataFrame, key: str, tie: str) -> tuple[DataFrame, DataFrame]:
    """The staged ``rows`` with ``part``, by their ``tie``, so that about ``TOGETHER`` rows of a key have
    the same; and ``key, part`` of all parts there can be. Facts of any size that are handed to each part
    of their key meet its rows in a shuffle that no key can make uneven."""
    sizes = staging.stage(rows.groupBy(key).agg(F.count("*").alias("n")), "deal-sizes")
    parts = sizes.select(key, "n", (F.floor(F.col("n") / TOGETHER) + 1).alias("parts"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    dealt = attach(rows, parts, key, total, "inner").withColumn("part", F.pmod(F.xxhash64(tie), "parts")).drop("parts")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    return dealt, parts.select(key, every.alias("part"))
