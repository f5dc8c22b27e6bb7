"""Bloom filters of ids, to keep rows that cannot match out of a shuffle; DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter: a multiple of the number of ids, between the size of one bitmap and 16 MB.
BITS_PER_ID = 16
LEAST, MOST = 1 << 15, 1 << 27


def _bit(bitmap: Column, place: Column) -> Column:
    """Whether a bit of a bitmap is set."""
    byte = F.conv(F.hex(F.substr(bitmap, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def mark(rows: DataFrame, ids: DataFrame, key: str, flag: str) -> DataFrame:
    """``rows`` with a column ``flag``: false only if the row's ``key`` is surely not among ``ids``, a
    staged table of that one column. What is broadcast has ``MOST`` bits at most, however many ids
    there are; with many more ids than that, more rows are marked in vain."""
    wanted = BITS_PER_ID * ids.count()
    bits = min(MOST, max(LEAST, 1 << max(0, wanted - 1).bit_length()))
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(bits)) + 1
    placed = ids.select(place.alias("place"))
    bitmaps = placed.groupBy(F.bitmap_bucket_number("place").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("__bitmap")
    )
    own = rows.withColumn("__place", place)
    own = own.withColumn("__bucket", F.bitmap_bucket_number("__place")).withColumn("__at", F.bitmap_bit_position("__place"))
    met = own.join(F.broadcast(bitmaps), "__bucket", "left")
    hit = F.coalesce(_bit(F.col("__bitmap"), F.col("__at")), F.lit(False))
    return met.select(*(F.col(f"`{c}`") for c in rows.columns), hit.alias(flag))


def among(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is among ``ids``; few others take part in the join."""
    marked = mark(rows, ids, key, "__maybe").where("__maybe").drop("__maybe")
    return marked.join(ids, key, "left_semi")


def outside(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is not among ``ids``, or null; most take no part in the join."""
    marked = mark(rows, ids, key, "__maybe")
    sure = marked.where("NOT __maybe").drop("__maybe")
    return sure.unionByName(marked.where("__maybe").drop("__maybe").join(ids, key, "left_anti"))
