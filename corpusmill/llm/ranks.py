"""Numbering rows in a total order with DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill import staging

#: Spark puts a row's place in its partition into the low bits of ``monotonically_increasing_id``.
PLACE_BITS = 33


def number_rows(df: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """``df`` staged with ``name``: each row's number from 0 on in the order of ``order``.

    Rows are dealt to ranges and sorted there; a row's number is its place in its range and the rows
    of the ranges before. ``order`` should tell any two rows apart, so that ranges can cut anywhere.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    staged = staging.stage(ranged.withColumn("__at", F.monotonically_increasing_id()), label)
    part = F.shiftrightunsigned("__at", PLACE_BITS)
    place = F.col("__at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    # one row for each range
    sizes = staged.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__base"))
    return (
        staged.withColumn("__part", part)
        .join(F.broadcast(bases), "__part")
        .select(*df.columns, (F.col("__base") + place).alias(name))
    )
