import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from corpusmill import constants as C
from corpusmill.operators import discovery as D
from corpusmill.sources import state


def test_grid_sizes(spark, tmp_path):
    path = tmp_path / "topics.txt"
    path.write_text("bert\ngpt\n\nbert\n yolo \n")
    topics = state.read_topics(spark, str(path))
    assert topics.count() == 3
    api, web = D.api_queries(topics), D.web_queries(topics)
    assert api.select("query_key").distinct().count() == 42 * 3
    assert web.select("query_key").distinct().count() == 108 * 3
    assert api.filter("query = 'language:python \"gpt\" in:readme stars:20..49'").count() == 3


def test_crawl_queries(spark):
    queries = D.crawl_queries(D.fixed_topics(spark), current=5000)
    got = {r.family: r["count"] for r in queries.groupBy("family").count().collect()}
    assert got == {"topic": 801, "recent": 30, "broad": 72, "year": 60, "readme": 28, "license": 8, "size": 8,
                   "filename": 10, "archived": 4}
    assert queries.select("query").distinct().count() == 435
    row = queries.filter("family = 'recent'").orderBy("query").first()
    assert row.query.endswith("pushed:>2023-01-01") and row.sort == "updated"
    lowest = D.crawl_queries(D.fixed_topics(spark), current=1)
    assert lowest.filter("family = 'topic'").count() == 89 * 3
    assert lowest.filter("family = 'broad' AND query LIKE '%stars:1..4%'").count() == 24


@pytest.mark.parametrize("current", [None, 5000, 500, 1, 77])
def test_star_ranges_in_both_forms(spark, current):
    levels = spark.createDataFrame([(v,) for v in C.STAR_LEVELS], "level long")
    got = [r.stars for r in D.star_ranges(levels, current).orderBy("tier").collect()]
    assert got == [text for text, _ in D.exclusive_ranges(C.STAR_LEVELS, current)]
    if current == 500:
        assert got[0] == "500..999"


def log(spark, rows):
    return spark.createDataFrame(rows, "query string, page long, found long, new long")


def test_frontier(spark):
    rows = [
        ("empty", 1, 0, 0), ("old4", 4, 100, 0), ("old5", 5, 100, 0), ("new9", 9, 100, 3), ("new10", 10, 100, 3),
        ("two", 1, 100, 9), ("two", 2, 0, 0), ("old9", 9, 50, 0),
    ]
    got = {r.query: (r.status, r.next_page) for r in D.query_frontier(log(spark, rows)).collect()}
    assert got == {
        "empty": ("done", None), "old4": ("open", 5), "old5": ("done", None), "new9": ("open", 10),
        "new10": ("done", None), "two": ("done", None), "old9": ("done", None),
    }


def test_short_page(spark):
    rows = [("full", 3, 100, 0), ("short", 3, 99, 5), ("last", 10, 100, 5)]
    got = {r.query: (r.status, r.next_page) for r in D.short_page_stop(log(spark, rows)).collect()}
    assert got == {"full": ("open", 4), "short": ("done", None), "last": ("done", None)}


def test_threshold_steps(spark):
    levels = spark.createDataFrame([(v,) for v in C.STAR_LEVELS], "level long")
    done = spark.createDataFrame([("a", "done"), ("b", "done")], "query string, status string")
    part = spark.createDataFrame([("a", "done"), ("b", "open")], "query string, status string")

    def step(states, current):
        row = D.next_threshold(levels, states, current).first()
        return row.can_expand, row.next_level

    assert step(done, 5000) == (True, 2000)
    assert step(part, 5000) == (True, 5000)
    assert step(done, 1) == (False, 1)
    assert step(done, 77) == (False, 77)


def test_page_map(spark):
    df = spark.createDataFrame([({"a": 3},)], "m map<string,bigint>")
    m = F.col("m")
    row = df.select(
        D.page_map(m, F.lit("a")).alias("a"),
        D.page_map(m, F.lit("b")).alias("b"),
        D.page_map_set(m, F.lit("a"), F.lit(4).cast("long")).alias("set"),
        D.page_map_done(m, F.lit("a")).alias("done"),
    ).first()
    assert (row.a, row.b, row["set"], row.done) == (3, 1, {"a": 4}, {})


def test_first_new_and_merged_hits(spark):
    hits = spark.createDataFrame([("r", 5), ("r", 2), ("s", 3), ("t", 1), ("u", 4)], "full_name string, seq long")
    names = lambda *v: spark.createDataFrame([(x,) for x in v], "full_name string")
    got = D.new_hits(hits, names("s"), names("t"), "full_name", ["seq"]).collect()
    assert sorted(tuple(r) for r in got) == [("r", 2), ("u", 4)]
    merged = D.merge_hits(names("r").withColumn("seq", F.lit(99).cast("long")), D.first_seen(hits, "full_name", ["seq"]))
    assert sorted(tuple(r) for r in merged.collect()) == [("r", 99), ("s", 3), ("t", 1), ("u", 4)]


def test_budget_and_target_include_the_crossing_row(spark):
    repos = spark.createDataFrame([(i, 10) for i in range(10)], "i long, tokens long")
    assert D.token_budget(repos, 25, ["i"]).count() == 3
    assert D.token_budget(repos, 30, ["i"]).count() == 3
    steps = repos.withColumnRenamed("tokens", "new")
    assert D.until_target(steps, 41, ["i"]).count() == 5


def test_request_rate_with_a_hot_minute(spark):
    rng = random.Random(1)
    start = datetime(2024, 1, 1)
    times = [start + timedelta(seconds=s) for s in [0, 0, 0, 59, 60, 61, 120]]
    times += [start + timedelta(seconds=1000, microseconds=rng.randint(0, 70_000_000)) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    got = {r.ts: r.requests for r in D.request_rate(df).collect()}
    minute = timedelta(seconds=60)
    assert got == {t: sum(t - minute < u <= t for u in times) for t in set(times)}
