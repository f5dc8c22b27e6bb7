"""Resumable jobs: each run takes the files that arrived since the last one and stops.

Progress lives in the checkpoint folder of the query, results in one folder per micro-batch
that is overwritten if the batch is repeated, so a lost executor or driver changes nothing.
State that grows with the keys is best kept in the RocksDB state store
(``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill import storage
from corpusmill.sources.state import path_exists

BATCH = "_batch"


def read_landing(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    *,
    pattern: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files as they arrive in ``folder``."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _run(stream: DataFrame, out: str, mode: str, sink: Callable[[DataFrame, int], None]) -> None:
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(sink)
        .start()
    )
    query.awaitTermination()


def _folders(spark: SparkSession, path: str) -> dict[int, str]:
    """Batch folders right below ``path`` by their number."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(hadoop_path):
        return {}
    names = [s.getPath().getName() for s in system.listStatus(hadoop_path)]
    return {int(n.partition("=")[2]): f"{path}/{n}" for n in names if n.startswith(f"{BATCH}=")}


def _results(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """All micro-batch folders below ``out``, and the last compacted one, with their batch numbers."""
    whole = T.StructType(schema.fields + [T.StructField(BATCH, T.LongType())])
    last = _compacted(spark, out)
    frames = [spark.read.schema(schema).parquet(path).withColumn(BATCH, F.lit(n).cast("long")) for n, path in last.items()]
    if _folders(spark, f"{out}/data"):
        after = max(last, default=-1)
        frames.append(spark.read.schema(whole).parquet(f"{out}/data").filter(F.col(BATCH) > after))
    if not frames:
        return spark.createDataFrame([], whole)
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def _compacted(spark: SparkSession, out: str) -> dict[int, str]:
    """The newest compacted folder that was written to its end."""
    found = {n: p for n, p in _folders(spark, f"{out}/compact").items() if path_exists(spark, f"{p}/_SUCCESS")}
    return {max(found): found[max(found)]} if found else {}


def _compact(spark: SparkSession, out: str, latest: DataFrame) -> None:
    """Replace the batch folders by ``latest``, what they add up to. A crash leaves the old folders
    or both; both read the same."""
    batches, older = _folders(spark, f"{out}/data"), _folders(spark, f"{out}/compact")
    if not batches:
        return
    last = max(batches)
    latest.write.mode("overwrite").parquet(f"{out}/compact/{BATCH}={last}")
    for number, path in [*batches.items(), *older.items()]:
        if path != f"{out}/compact/{BATCH}={last}" and number <= last:
            storage.delete(spark, path)


def append(stream: DataFrame, out: str) -> DataFrame:
    """Append every row once, however often the job is started."""

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/data/{BATCH}={number}")

    _run(stream, out, "append", sink)
    return _results(stream.sparkSession, out, stream.schema).drop(BATCH)


def keep_latest(aggregated: DataFrame, out: str, keys: list[str]) -> DataFrame:
    """Running aggregate: each micro-batch adds the groups that changed, the last value counts. At
    the end of a run the batches are compacted to one row per group."""

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/data/{BATCH}={number}")

    spark = aggregated.sparkSession
    _run(aggregated, out, "update", sink)
    values = [c for c in aggregated.columns if c not in keys]

    def latest() -> DataFrame:
        rows = _results(spark, out, aggregated.schema).groupBy(*keys)
        return rows.agg(F.max_by(F.struct(*values), F.col(BATCH)).alias("_last")).select(*keys, "_last.*")

    _compact(spark, out, latest())
    return _results(spark, out, aggregated.schema).drop(BATCH)


def running_totals(stream: DataFrame, out: str, key: str, sums: dict[str, Column]) -> DataFrame:
    """Totals per ``key`` over everything that has arrived."""
    totals = stream.groupBy(key).agg(*[F.sum(value).alias(name) for name, value in sums.items()])
    return keep_latest(totals, out, [key])


def running_first_seen(stream: DataFrame, out: str, key: str, order_by: list[str]) -> DataFrame:
    """First row of every key; the state holds one row per key for ever, as a seen-set does."""
    whole = F.struct(*order_by, *[c for c in stream.columns if c not in order_by])
    first = stream.groupBy(key).agg(F.min(whole).alias("_first"))
    return keep_latest(first, out, [key]).select("_first.*")


def add_up(stream: DataFrame, out: str, partial: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    """Running sums without any state: ``partial`` makes of each micro-batch rows of ``keys`` and long
    counts, which are added up when they are read, and compacted to one row for each key at the end of a
    run. Rows may come in any order and any time late; a batch costs what it holds."""
    spark = stream.sparkSession
    schema = partial(spark.createDataFrame([], stream.schema)).schema
    counts = [c for c in schema.fieldNames() if c not in keys]

    def sink(batch: DataFrame, number: int) -> None:
        partial(batch).write.mode("overwrite").parquet(f"{out}/data/{BATCH}={number}")

    _run(stream, out, "append", sink)

    def whole() -> DataFrame:
        return _results(spark, out, schema).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])

    _compact(spark, out, whole())
    return whole()


def request_rate(
    stream: DataFrame,
    out: str,
    *,
    column: str = "ts",
    window: str = "60 seconds",
    step: str = "10 seconds",
) -> DataFrame:
    """Requests per sliding window. Landed files have no order in time; counts of windows add up over
    micro-batches, so there is neither a watermark, which would lose late rows, nor state, which would
    have to keep every window. ``column`` is cast to a timestamp with zone; the session time zone should
    be UTC."""

    def partial(batch: DataFrame) -> DataFrame:
        timed = batch.select(F.col(column).cast("timestamp").alias("ts"))
        return (
            timed.groupBy(F.window("ts", window, step).alias("w"))
            .agg(F.count(F.lit(1)).alias("requests"))
            .select(
                F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                "requests",
            )
        )

    return add_up(stream, out, partial, ["window_start", "window_end"])


def merge(stream: DataFrame, out: str, key: str, order_by: list[str]) -> DataFrame:
    """Append-only merge: a micro-batch adds the keys that no earlier one has, each with its first
    row of that batch. The keys seen are in the state store, so a batch costs what it holds.

    All rows of a batch have the batch's time, so a group whose oldest and newest time agree is new.
    """
    schema, time = stream.schema, F.current_timestamp()
    first = F.min(F.struct(*order_by, *[c for c in stream.columns if c not in order_by]))
    grouped = stream.withColumn("_time", time).groupBy(F.col(key).alias("_key"))
    seen = grouped.agg(first.alias("_first"), F.min("_time").alias("_old"), F.max("_time").alias("_new"))

    def sink(batch: DataFrame, number: int) -> None:
        new = batch.filter("_old = _new").select("_first.*").select(*schema.fieldNames())
        new.write.mode("overwrite").parquet(f"{out}/data/{BATCH}={number}")

    _run(seen, out, "update", sink)
    return _results(stream.sparkSession, out, schema).drop(BATCH)
