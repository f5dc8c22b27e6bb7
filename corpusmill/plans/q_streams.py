"""Queries that run a stream over the given tables to its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill import staging
from corpusmill.functions.tokens import count_tokens
from corpusmill.plans import views as V
from corpusmill.plans.registry import query
from corpusmill.streaming import ingest


PIECES, FILES = 3, 4


def _landing(spark, sf, name, column, in_order=False):
    """The table, landed as files of several micro-batches: in the order of ``column``, or each batch
    with rows from the whole range and later rows first."""
    rows = V.table(spark, sf, name)
    low, high = rows.agg(F.min(column), F.max(column)).first()
    width = ((high or 0) - (low or 0)) // PIECES + 1
    piece = F.floor((F.col(column) - F.lit(low or 0)) / F.lit(width)) if in_order else F.pmod(column, F.lit(PIECES))
    folder = staging.new_path(spark, "landing")
    for number in range(PIECES):
        wanted = number if in_order else PIECES - 1 - number
        rows.filter(piece == wanted).repartition(FILES).write.mode("append").parquet(folder)
    return ingest.read_landing(spark, folder, rows.schema, files_per_batch=FILES)


def _out(spark):
    return staging.new_path(spark, "stream")


@query("stream_ingest", "SELECT event_id, user_id, event_type FROM events")
def stream_ingest(spark, sf):
    return ingest.append(_landing(spark, sf, "events", "event_id").select("event_id", "user_id", "event_type"), _out(spark))


@query(
    "stream_totals",
    f"""SELECT source, CAST(sum({V.TOKENS_SQL.format("text")}) AS BIGINT) AS tokens, count(*) AS files
    FROM documents GROUP BY source""",
)
def stream_totals(spark, sf):
    sums = {"tokens": count_tokens(F.col("text")), "files": F.lit(1).cast("long")}
    return ingest.running_totals(_landing(spark, sf, "documents", "doc_id"), _out(spark), "source", sums)


@query(
    "stream_first_seen",
    "SELECT min(event_id) AS seq, user_id AS repo_id FROM events GROUP BY user_id",
)
def stream_first_seen(spark, sf):
    landed = _landing(spark, sf, "events", "event_id")
    hits = landed.select(F.col("event_id").alias("seq"), F.col("user_id").alias("repo_id"))
    return ingest.running_first_seen(hits, _out(spark), "repo_id", ["seq"])


@query(
    "stream_merge",
    """SELECT query, repo_id, seq FROM (SELECT event_type AS query, user_id AS repo_id, event_id AS seq,
      row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn = 1""",
)
def stream_merge(spark, sf):
    hits = _landing(spark, sf, "events", "event_id", in_order=True).select(
        F.col("event_type").alias("query"), F.col("user_id").alias("repo_id"), F.col("event_id").alias("seq")
    )
    return ingest.merge(hits, _out(spark), "repo_id", ["seq"])


@query(
    "stream_rate",
    """WITH v_us AS (SELECT epoch_us(ts) AS us FROM events),
    v_slots AS (SELECT (us // 10000000 - s) * 10000000 AS start_us FROM v_us, range(6) r(s))
    SELECT CAST(start_us AS BIGINT) AS start_us, count(*) AS requests FROM v_slots GROUP BY start_us""",
)
def stream_rate(spark, sf):
    rate = ingest.request_rate(_landing(spark, sf, "events", "event_id").select("ts"), _out(spark))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return rate.select(F.timestamp_diff("MICROSECOND", epoch, F.col("window_start")).alias("start_us"), "requests")
