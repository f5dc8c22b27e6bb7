"""Greedy packing of files into size-bounded shards, exact and in parallel.

The rule walks the files in canonical order. Before a file is added, the open shard is closed
if the file would lift it over ``max_size`` and it holds at least ``min_size``; after a file is
added, the shard is closed once it holds ``target``. The sum restarts at every shard, so no
window function expresses it. But where a shard that starts at byte ``b`` of the running total
ends depends on ``b`` alone: only the file that covers byte ``b + target`` can close it. So:

1. running byte offsets of all files (:func:`corpusmill.operators.ordering.running_sums`);
2. for every file as a possible shard start, the start after it ("jump"), from an ordered
   lookup of ``b + target`` within fixed byte buckets;
3. jumps over ever wider byte spans, by joining the jump table to itself. The first start in a
   span lies within ``reach`` of its beginning, or right after a file of at least ``target``
   bytes. No other start matters, so each table is about half the size of the one before;
4. once the span covers everything, byte 0 is the only start left; the way back down through the
   spans gives the starts that are really taken;
5. every file looks up its shard.

Nothing passes through one task or the driver, and no bucket holds more than its width in files,
because every file in it has at least one byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill import staging
from corpusmill.constants import SHARD_MAX, SHARD_MIN, SHARD_TARGET
from corpusmill.functions.units import shard_label
from corpusmill.operators.ordering import running_sums

LOOKUP_BUCKET_BYTES = 1024 * 1024
TOUCHED_BUCKETS = 1024 * 1024


def _div(value: Column, width: int) -> Column:
    """Integer division, exact beyond 2**53."""
    return F.call_function("div", value, F.lit(width).cast("long"))


def _first_jumps(
    files: DataFrame, total: int, largest: int, target: int, min_size: int, max_size: int
) -> DataFrame:
    """For every file as a shard start: where the next shard starts and whether the current one
    was closed after a file (``True``) or before one that did not fit (``False``).

    The file that covers byte ``at + target`` is found in byte buckets: files lie at their last
    byte within each bucket they touch, so the first one at or after the byte is the answer.
    """
    width = max(LOOKUP_BUCKET_BYTES, largest // TOUCHED_BUCKETS)
    files = files.filter("size > 0").select(F.col("_start").alias("at"), F.col("_end").alias("end"))
    touched = files.select(
        F.explode_outer(F.sequence(_div(F.col("at") + 1, width), _div(F.col("end"), width))).alias("bucket"),
        "at",
        "end",
    )
    marks = touched.select(
        "bucket",
        F.least("end", (F.col("bucket") + 1) * width - 1).alias("byte"),
        F.lit(True).alias("is_file"),
        F.col("at").alias("file_start"),
        F.col("end").alias("file_end"),
        F.lit(None).cast("long").alias("at"),
    )
    wanted = F.col("at") + F.lit(target).cast("long")
    probes = files.filter(wanted <= total).select(
        _div(wanted, width).alias("bucket"),
        wanted.alias("byte"),
        F.lit(False).alias("is_file"),
        F.lit(None).cast("long").alias("file_start"),
        F.lit(None).cast("long").alias("file_end"),
        "at",
    )
    from_above = (
        Window.partitionBy("bucket")
        .orderBy(F.desc("byte"), F.desc("is_file"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    met = (
        marks.unionByName(probes)
        .withColumn("file_start", F.last("file_start", ignorenulls=True).over(from_above))
        .withColumn("file_end", F.last("file_end", ignorenulls=True).over(from_above))
        .filter("not is_file")
    )
    refused = (F.col("file_start") - F.col("at") >= max(min_size, 1)) & (
        F.col("file_end") - F.col("at") > max_size
    )
    return met.select(
        "at",
        F.when(refused, F.col("file_start")).otherwise(F.col("file_end")).alias("to"),
        (~refused).alias("after_file"),
    )


def _wider(jumps: DataFrame, span: int, reach: int) -> DataFrame:
    """Jumps that leave spans of ``span`` bytes, from jumps that leave their halves."""
    needed = jumps.filter((F.col("at") % span < reach) | F.col("after_giant"))
    same_span = _div(F.col("at"), span) == _div(F.col("to"), span)
    inside = needed.filter(same_span).select(
        "at", "after_giant", F.col("to").alias("via"), F.col("hops").alias("hops_in")
    )
    outer = jumps.select(F.col("at").alias("via"), "to", "after_file", "hops")
    onward = inside.join(outer, "via").select(
        "at", "after_giant", "to", "after_file", (F.col("hops_in") + F.col("hops")).alias("hops")
    )
    return needed.filter(~same_span).unionByName(onward)


_START = "at long, shard long, after_file boolean"


def _taken_starts(
    first: DataFrame, giants: DataFrame | None, bounds: Row, shortest: int, reach: int
) -> tuple[DataFrame, int]:
    """Starts of all shards (``at, shard, after_file``) and their number.

    ``after_file`` tells whether the shard before was closed after a file, so that empty files
    at the same byte belong to the new shard. ``giants`` holds the ends of files of at least
    ``target`` bytes, if there are any.
    """
    total = bounds["total"]
    # a jump to the very end opens no further shard
    jumps = first.filter(F.col("to") < total).withColumn("hops", F.lit(1).cast("long"))
    if giants is None:
        jumps = jumps.withColumn("after_giant", F.lit(False))
    else:
        marked = jumps.join(giants.withColumn("after_giant", F.lit(True)), "at", "left")
        jumps = marked.withColumn("after_giant", F.coalesce("after_giant", F.lit(False)))
    levels, span = [jumps], shortest
    while span < total:
        wider = _wider(levels[-1], span * 2, reach)
        # every other level is worked out again where it is needed, which costs less than to write it
        levels.append(staging.stage(wider, "jumps") if len(levels) % 2 == 0 else wider)
        span *= 2

    starts = first.sparkSession.createDataFrame([(0, 0, True)], _START)
    for level in reversed(range(len(levels) - 1)):
        jumps = levels[level]
        inner = starts.select("at", "shard").join(jumps, "at")
        inner = inner.filter(_div(F.col("at"), span) == _div(F.col("to"), span))
        more = inner.select(
            F.col("to").alias("at"), (F.col("shard") + F.col("hops")).alias("shard"), "after_file"
        )
        starts = starts.unionByName(more)
        if level % 2 == 0:
            starts = staging.stage(starts, "starts")
        span //= 2
    return starts, starts.count()


def _key(byte: Column, after_file: Column) -> Column:
    """Place of a shard boundary among the file keys of :func:`assign_shards`."""
    return byte * 2 + F.when(after_file, 0).otherwise(1)


def _shard_bounds(starts: DataFrame, first: DataFrame, total: int) -> DataFrame:
    """``shard, low, high``: half-open intervals of file keys."""
    end = F.lit(2 * total + 2).cast("long")
    closing = first.select("at", "to", F.col("after_file").alias("closed_after"))
    bounds = starts.join(closing, "at", "left").select(
        "shard",
        _key(F.col("at"), F.col("after_file")).alias("low"),
        F.coalesce(_key(F.col("to"), F.col("closed_after")), end).alias("high"),
    )
    own = F.struct("shard", "low", "high")
    # empty files after a shard that is closed by the very last byte open one more
    more = F.struct((F.col("shard") + 1).alias("shard"), F.col("high").alias("low"), end.alias("high"))
    rows = F.when(F.col("high") == 2 * total, F.array(own, more)).otherwise(F.array(own))
    return bounds.select(F.inline_outer(rows))


def assign_shards(
    index: DataFrame,
    *,
    target: int = SHARD_TARGET,
    min_size: int = SHARD_MIN,
    max_size: int = SHARD_MAX,
) -> DataFrame:
    """Set ``shard_id`` of every file of ``index`` by the greedy rule in canonical order.

    Shard numbers are dense from 0; the last shard may be short. No shard is empty, so a file
    over ``max_size`` opens its shard even if ``min_size`` is 0. Stage ``index`` first if it is
    costly to compute: it is read three times.
    """
    if not (0 <= min_size <= target <= max_size and target >= 1):
        raise ValueError("need 0 <= min_size <= target <= max_size and target >= 1")
    size = F.col("size")
    bounds = index.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(size), F.lit(0)).alias("total"),
        F.coalesce(F.max(size), F.lit(0)).alias("largest"),
        F.coalesce(F.max(F.when(size < target, size)), F.lit(0)).alias("largest_below"),
    ).first()
    total, largest = bounds["total"], bounds["largest"]
    order = ["project_name", "file_path"]
    files = running_sums(index.drop("shard_id"), order, {"_end": "size"}, rows=bounds["rows"])
    files = files.withColumn("_start", F.col("_end") - F.col("size"))
    columns = [F.col(c) for c in index.columns if c != "shard_id"]
    if total == 0:
        return files.select(*columns, shard_label(F.lit(0)).alias("shard_id"))

    first = staging.stage(_first_jumps(files, total, largest, target, min_size, max_size), "jumps")
    giants = files.filter(size >= target).select(F.col("_end").alias("at")) if largest >= target else None
    # no shard is shorter, so a span of this width holds at most one start
    shortest = target if largest <= max_size - target else max(min_size, 1)
    starts, count = _taken_starts(first, giants, bounds, shortest, target + bounds["largest_below"])
    shards = _shard_bounds(starts, first, total)
    # an empty file lies before the non-empty one that starts at the same byte
    key = F.col("_start") * 2 + F.when(size > 0, 1).otherwise(0)
    width = 2 * max(min_size, 1, -(-total // count))
    covering = shards.select(
        F.explode_outer(F.sequence(_div(F.col("low"), width), _div(F.col("high") - 1, width))).alias("_bucket"),
        "shard",
        "low",
        "high",
    )
    placed = files.withColumn("_key", key).withColumn("_bucket", _div(F.col("_key"), width))
    return (
        placed.join(covering, "_bucket")
        .filter((F.col("low") <= F.col("_key")) & (F.col("_key") < F.col("high")))
        .select(*columns, shard_label(F.col("shard")).alias("shard_id"))
    )


def shard_stats(assigned: DataFrame) -> DataFrame:
    """Files, bytes and tokens of every shard."""
    return assigned.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("size").alias("bytes"),
        F.sum("tokens").alias("tokens"),
    )


#: Files of a project that one task sums up; larger projects are cut into ranges.
FILES_PER_WINDOW = 1_000_000


def assign_shards_prefix(index: DataFrame, *, target: int = SHARD_TARGET) -> DataFrame:
    """Shards by prefix sums: a file's shard is the number of whole ``target`` bytes before it in
    canonical order, so a shard holds at most ``target`` bytes and one file, and small shards do not grow.

    Totals of projects give each project its base; within projects bytes are summed up by project, those
    with more than ``FILES_PER_WINDOW`` files in ranges. Only project totals are sorted as a whole.
    ``index`` should be staged. Shards that no file begins in have no rows.
    """
    size = F.coalesce("size", F.lit(0))
    totals = index.groupBy("project_name").agg(F.sum(size).alias("_bytes"), F.count(F.lit(1)).alias("_files"))
    totals = staging.stage(totals, "project-bytes")
    summed = running_sums(totals, ["project_name"], {"_upto": "_bytes"})
    bases = staging.stage(summed.select("project_name", "_files", (F.col("_upto") - F.col("_bytes")).alias("_base")), "project-bases")
    large = F.broadcast(bases.filter(F.col("_files") > FILES_PER_WINDOW).select("project_name", "_base"))
    within = Window.partitionBy("project_name").orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
    usual = index.join(large.select("project_name"), "project_name", "left_anti").join(bases.drop("_files"), "project_name")
    usual = usual.withColumn("_before", F.col("_base") + F.coalesce(F.sum(size).over(within), F.lit(0)))
    hot = running_sums(index.join(large.select("project_name"), "project_name", "left_semi"), ["project_name", "file_path"], {"_upto": "size"})
    # ranges of all large projects are summed in one order; what came before a project is taken off again
    first = totals.join(large, "project_name").select("project_name", "_bytes", "_base")
    first = running_sums(first, ["project_name"], {"_sum": "_bytes"})
    shift = F.broadcast(first.select("project_name", (F.col("_base") - (F.col("_sum") - F.col("_bytes"))).alias("_shift")))
    hot = hot.join(shift, "project_name").withColumn("_before", F.col("_shift") + F.col("_upto") - size)
    both = usual.select(*index.columns, "_before").unionByName(hot.select(*index.columns, "_before"))
    return both.withColumn("shard_id", shard_label(_div(F.col("_before"), target))).select(*index.columns)
