import datetime
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.streaming import ingest


@pytest.fixture
def landing(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, f"u{rng.randint(0, 40)}", rng.randint(1, 9)) for i in range(900)]
    schema = "seq long, repo string, tokens long"
    folder = tmp_path / "landing"

    def land(start, end):
        part = spark.createDataFrame(rows[start:end], schema)
        part.coalesce(1).write.mode("append").parquet(str(folder))

    land(0, 300)
    land(300, 600)
    return rows, str(folder), schema, land


def open_stream(spark, folder, schema):
    parsed = spark.createDataFrame([], schema).schema
    return ingest.read_landing(spark, folder, parsed, files_per_batch=1)


def test_append_takes_every_row_once_over_restarts(spark, landing, tmp_path):
    rows, folder, schema, land = landing
    out = str(tmp_path / "out")
    assert ingest.append(open_stream(spark, folder, schema), out).count() == 600
    assert ingest.append(open_stream(spark, folder, schema), out).count() == 600
    land(600, 900)
    got = ingest.append(open_stream(spark, folder, schema), out).collect()
    assert sorted(tuple(r) for r in got) == sorted(rows)


def totals_of(rows):
    out = {}
    for _, repo, tokens in rows:
        out[repo] = out.get(repo, 0) + tokens
    return out


def test_running_totals_equal_batch(spark, landing, tmp_path):
    rows, folder, schema, land = landing
    out = str(tmp_path / "out")
    sums = {"tokens": F.col("tokens")}
    got = ingest.running_totals(open_stream(spark, folder, schema), out, "repo", sums)
    assert {r.repo: r.tokens for r in got.collect()} == totals_of(rows[:600])
    land(600, 900)
    got = ingest.running_totals(open_stream(spark, folder, schema), out, "repo", sums)
    assert {r.repo: r.tokens for r in got.collect()} == totals_of(rows)


def test_first_seen_and_merge_equal_batch(spark, landing, tmp_path):
    rows, folder, schema, land = landing
    first = {}
    for seq, repo, _ in rows[:600]:
        first.setdefault(repo, seq)
    got = ingest.running_first_seen(open_stream(spark, folder, schema), str(tmp_path / "f"), "repo", ["seq"])
    assert {r.repo: r.seq for r in got.collect()} == first
    merged = ingest.merge(open_stream(spark, folder, schema), str(tmp_path / "m"), "repo", ["seq"]).collect()
    assert len(merged) == len(first)  # one row per key, from whichever file came first
    land(600, 900)
    again = ingest.merge(open_stream(spark, folder, schema), str(tmp_path / "m"), "repo", ["seq"]).collect()
    kept = {r.repo: r.seq for r in merged}
    assert all({r.repo: r.seq for r in again}[k] == v for k, v in kept.items())
    assert len(again) == len({r[1] for r in rows})


def test_windowed_rate_equals_batch(spark, tmp_path):
    df = spark.range(300).select(
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 7 % 500)).alias("ts")
    )
    folder = str(tmp_path / "t")
    df.coalesce(1).write.parquet(folder)
    got = ingest.request_rate(ingest.read_landing(spark, folder, df.schema), str(tmp_path / "o")).collect()
    times = [r.ts for r in df.collect()]
    assert sum(r.requests for r in got) == 6 * len(times)
    assert all(r.requests == sum(r.window_start <= t < r.window_end for t in times) for r in got)


def test_rate_far_out_of_order_keeps_no_state(spark, tmp_path):
    """Months of requests in any order over restarts: nothing is lost and no state is kept."""
    rng = random.Random(8)
    seconds = [rng.randrange(0, 120 * 86400, 7) for _ in range(300)] + [5] * 40 + [60 * 86400 + i for i in range(60)]
    rng.shuffle(seconds)
    folder, out, expected = tmp_path / "landing", str(tmp_path / "out"), {}
    for run, low in enumerate(range(0, 400, 100)):
        part = spark.createDataFrame([(s,) for s in seconds[low : low + 100]], "s long").select(F.timestamp_seconds("s").alias("ts"))
        part.repartition(3).write.mode("append").parquet(str(folder))
        for s in seconds[low : low + 100]:
            for start in range(s // 10 * 10 - 50, s // 10 * 10 + 1, 10):
                expected[start] = expected.get(start, 0) + 1
        stream = ingest.read_landing(spark, str(folder), part.schema, files_per_batch=2)
        rows = ingest.request_rate(stream, out).collect()
        epoch = datetime.datetime(1970, 1, 1)
        assert {(r.window_start - epoch) // datetime.timedelta(seconds=1): r.requests for r in rows} == expected
        assert len(rows) == len(expected) and run == low // 100
        assert not (tmp_path / "out" / "checkpoint" / "state").exists()
    assert [p.name for p in (tmp_path / "out" / "data").iterdir()] == []
    again = ingest.request_rate(ingest.read_landing(spark, str(folder), part.schema), out)
    assert again.agg(F.sum("requests")).first()[0] == 6 * 400
