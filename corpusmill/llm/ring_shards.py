"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands on the ring as ``nodes`` points, hashes of its number. A document's key, the hash
of its text, stands on the ring too and belongs to the next point clockwise, so equal texts belong
together. A shard holds no more than its capacity: with ``slack`` s, the mean number of rows times
1 + s, rounded up; without slack, the rows are dealt out to the last one, so that counts differ by
one at most. A shard's own keys come first, in the order of another hash. What is beyond its capacity
goes on clockwise to the next point whose shard has room, first come first served, where a shard
that is not filled by its own keys offers its room in equal parts at its points. A document thus stays
on its own shard unless that is full, and a new shard takes keys over near its own points only.

All is DataFrame functions: rows are numbered within their shard through ranges, never in one task;
the flow along the ring is prefix sums over ``shards * nodes`` points, two rounds of the ring, as what
arrives at the first point is what leaves the last. The only broadcast tables are of that size, or
have ``CELLS`` rows more, or one row a range.

Defined results: a null text counts as an empty one, of 0 bytes, with the same key; texts of any
length are hashed whole; repeated rows are placed one by one, next to each other as long as there is
room; ids may be null or repeat; an empty table gives an empty table. Columns to keep are packed into
``row``, so no name can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill import staging
from corpusmill.llm import ranks

SHARDS = 40
NODES = 64
#: Parts of the ring, or of what flows on it, in which points are looked up.
CELLS = 4096
#: Hashes have so many bits, 15 hexadecimal digits.
BITS = 60
OVERHEAD = 16


def place_of(digest: Column, start: int = 1) -> Column:
    """Fifteen hexadecimal digits as a number."""
    return F.conv(F.substring(digest, start, BITS // 4), 16, 10).cast("bigint")


def ring(spark: SparkSession, shards: int, nodes: int) -> DataFrame:
    """``node, place, shard, part``: points in the order of the ring, numbered from 0 on, and the
    number of each among those of its shard."""
    shard, copy = (F.col("id") % shards).cast("int"), F.floor(F.col("id") / shards)
    place = place_of(F.md5(F.concat_ws("-", F.lit("shard"), shard.cast("string"), copy.cast("string")).cast("binary")))
    points = spark.range(0, shards * nodes, 1, 1).select(place.alias("place"), shard.alias("shard"))
    order = Window.orderBy("place", "shard")
    return points.select(
        (F.row_number().over(order) - 1).alias("node"),
        "place",
        "shard",
        (F.row_number().over(Window.partitionBy("shard").orderBy("place")) - 1).alias("part"),
    )


def cells(points: DataFrame) -> DataFrame:
    """For each of ``CELLS`` parts of the ring the points in it, and the next one behind it."""
    cell = F.shiftright("place", BITS - CELLS.bit_length() + 1)
    own = points.groupBy(cell.alias("cell")).agg(F.sort_array(F.collect_list(F.struct("place", "node", "shard"))).alias("points"))
    every = points.sparkSession.range(0, CELLS, 1, 1).withColumnRenamed("id", "cell").join(own, "cell", "left")
    later = Window.orderBy("cell").rowsBetween(1, Window.unboundedFollowing)
    whole = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.col("points")[0]
    behind = F.coalesce(F.first(first, ignorenulls=True).over(later), F.first(first, ignorenulls=True).over(whole))
    return every.select("cell", "points", behind.alias("behind"))


def flow(points: DataFrame, excess: DataFrame, loads: DataFrame, nodes: int) -> DataFrame:
    """Every point with the rows of its own that go on (``over``), those that it takes (``taken``),
    and its number (``turn``) counted from behind a point that nothing passes."""
    room = F.floor(F.col("room") / nodes) + F.when(F.col("part") < F.col("room") % nodes, 1).otherwise(0)
    filled = (
        points.join(F.broadcast(loads.select("shard", "room")), "shard")
        .join(F.broadcast(excess), "node", "left")
        .select("node", "shard", F.coalesce("over", F.lit(0)).alias("over"), room.cast("bigint").alias("spare"))
    )
    twice = filled.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("round"))
    order = Window.orderBy("round", "node")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    summed = twice.withColumn("sum", F.sum(F.col("over") - F.col("spare")).over(so_far))
    passing = summed.withColumn("on", F.col("sum") - F.least(F.lit(0), F.min("sum").over(so_far)))
    arriving = F.coalesce(F.lag("on").over(order), F.lit(0))
    last = passing.withColumn("taken", arriving + F.col("over") - F.col("on")).where("round = 1")
    quiet = F.min(F.when(F.col("on") == 0, F.col("node"))).over(Window.partitionBy())
    count = F.count("*").over(Window.partitionBy())
    return last.select("node", "shard", "over", "taken", F.pmod(F.col("node") - quiet - 1, count).alias("turn"))


def place_documents(
    df: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    keep: list[str] | None = None,
    shards: int = SHARDS,
    nodes: int = NODES,
    slack: float = 0.0,
) -> DataFrame:
    """``row, size, text_crc32, home, shard, slot`` for every row: the columns in ``keep`` (``id`` if
    none are named), bytes of the text and ``OVERHEAD``, the shard its key belongs to and the one
    that has room, and its number there."""
    spark = df.sparkSession
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digest = F.md5(body.cast("binary"))
    points = staging.stage(ring(spark, shards, nodes), "ring-points")
    keyed = df.select(
        F.struct(*(F.col(f"`{c}`") for c in keep or [id])).alias("row"),
        F.col(f"`{id}`").alias("id"),
        (F.octet_length(body) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        place_of(digest).alias("place"),
        place_of(digest, 16).alias("rank"),
        F.monotonically_increasing_id().alias("copy"),
    ).withColumn("cell", F.shiftright("place", BITS - CELLS.bit_length() + 1))
    met = keyed.join(F.broadcast(cells(points)), "cell")
    point = F.coalesce(F.get(F.filter("points", lambda p: p.place >= F.col("place")), F.lit(0)), F.col("behind"))
    homed = met.withColumn("point", point).select(
        "row", "id", "size", "text_crc32", "rank", "copy", F.col("point.node").alias("node"), F.col("point.shard").alias("home")
    )
    homed = staging.stage(homed, "ring-homes")

    counts = homed.groupBy(F.col("home").alias("shard")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    mean = F.floor(total / shards) + F.when(F.col("shard") < total % shards, 1).otherwise(0)
    capacity = F.ceil(total * (1 + slack) / shards) if slack else mean
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    loads = (
        spark.range(0, shards, 1, 1)
        .select(F.col("id").cast("int").alias("shard"))
        .join(counts, "shard", "left")
        .select("shard", F.coalesce("n", F.lit(0)).alias("n"))
        .select("shard", "n", capacity.cast("bigint").alias("capacity"), F.coalesce(before, F.lit(0)).alias("base"))
        .select("shard", "base", F.least("n", "capacity").alias("own"), (F.col("capacity") - F.least("n", "capacity")).alias("room"))
    )
    loads = staging.stage(loads, "ring-loads")

    order = [F.col(c) for c in ("home", "rank", "id", "copy")]
    numbered = ranks.number_rows(homed, order, "number", "ring-ranks")
    ranked = numbered.join(F.broadcast(loads.withColumnRenamed("shard", "home")), "home").withColumn(
        "slot", F.col("number") - F.col("base")
    )
    columns = ["row", "size", "text_crc32", "home", "shard", "slot"]
    stay = ranked.where("slot < own").withColumn("shard", F.col("home")).select(*columns)
    over = ranked.where("slot >= own").select("row", "size", "text_crc32", "home", "node", "rank", "id", "copy")

    excess = over.groupBy("node").agg(F.count("*").alias("over"))
    flows = staging.stage(flow(points, excess, loads, nodes), "ring-flow")
    turns = F.broadcast(flows.select("node", "turn"))
    waiting = ranks.number_rows(
        over.join(turns, "node").drop("node"), [F.col(c) for c in ("turn", "rank", "id", "copy")], "unit", "ring-over"
    )
    upto = F.sum("taken").over(Window.orderBy("turn").rowsBetween(Window.unboundedPreceding, 0))
    within = F.sum("taken").over(Window.partitionBy("shard").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1))
    wide = (flows.agg(F.sum("taken")).first()[0] or 0) // CELLS + 1
    offers = (
        flows.select("shard", "taken", (upto - F.col("taken")).alias("low"), upto.alias("high"), within.alias("within"))
        .where("taken > 0")
        .join(loads.select("shard", "own"), "shard")
        .select("shard", "low", "high", (F.col("own") + F.coalesce("within", F.lit(0))).alias("first"))
        .withColumn("cell", F.explode(F.expr(f"sequence(low div {wide}, (high - 1) div {wide})")))
    )
    moved = (
        waiting.withColumn("cell", F.expr(f"unit div {wide}"))
        .join(F.broadcast(offers), "cell")
        .where("low <= unit AND unit < high")
        .withColumn("slot", F.col("first") + F.col("unit") - F.col("low"))
        .select(*columns)
    )
    return stay.unionByName(moved)
