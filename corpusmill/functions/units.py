"""Sizes, rates, durations and shard names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shard_label(number: Column) -> Column:
    return F.format_string("%05d", number)


def shard_file(number: Column) -> Column:
    return F.format_string("shard_%05d.tar.zst", number)


def shard_metadata_file(number: Column) -> Column:
    return F.format_string("shard_%05d_metadata.parquet", number)


def mib(size: Column) -> Column:
    return size / F.lit(1024.0) / F.lit(1024.0)


def gib(size: Column) -> Column:
    return mib(size) / F.lit(1024.0)


def percent(part: Column, whole: Column) -> Column:
    return part / whole * F.lit(100.0)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds between two timestamps without zone, as double."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return micros.cast("double") / F.lit(1e6)


def per_second(amount: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, amount / seconds).otherwise(F.lit(0.0))


def per_minute(amount: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, amount / seconds * F.lit(60.0)).otherwise(F.lit(0.0))


def eta_seconds(done: Column, target: Column, rate: Column) -> Column:
    """Seconds left at ``rate``; null while nothing has been done."""
    return F.when(rate > 0, (target - done) / rate)


def eta_text(seconds: Column) -> Column:
    """Days from one day on, hours from one hour on, otherwise minutes, with one decimal."""
    hours = F.pmod(seconds, F.lit(86400.0)) / F.lit(3600.0)
    return (
        F.when(seconds / 86400.0 >= 1, F.format_string("%.1f days", seconds / 86400.0))
        .when(hours >= 1, F.format_string("%.1f hours", hours))
        .when(seconds.isNotNull(), F.format_string("%.1f minutes", seconds / 60.0))
    )
