import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import packing
from corpusmill.operators.ordering import batch_ids, running_sums


def greedy(sizes, target, low, high):
    """Plain sequential statement of the rule, to compare with."""
    out, shard, held, any_file = [], 0, 0, False
    for size in sizes:
        if any_file and held > 0 and held + size > high and held >= low:
            shard, held, any_file = shard + 1, 0, False
        out.append(shard)
        held, any_file = held + size, True
        if held >= target:
            shard, held, any_file = shard + 1, 0, False
    return out


def make_index(spark, sizes):
    rows = [(f"p{i // 37:03d}", f"f{i:05d}", 1, s, "x", None) for i, s in enumerate(sizes)]
    schema = "project_name string, file_path string, tokens long, size long, sha256 string, shard_id string"
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, schema).repartition(5)


def check(spark, sizes, target, low, high):
    got = packing.assign_shards(make_index(spark, sizes), target=target, min_size=low, max_size=high)
    rows = sorted(got.select("file_path", "shard_id").collect())
    assert [int(r.shard_id) for r in rows] == greedy(sizes, target, low, high)


CASES = {
    "uniform": ([10] * 300, 95, 50, 200),
    "max_branch": ([random.Random(3).randint(0, 60) for _ in range(400)], 50, 5, 55),
    "zeros_everywhere": ([random.Random(4).choice([0, 0, 0, 7, 19]) for _ in range(400)], 40, 10, 45),
    "giant_file": ([5] * 50 + [5000] + [5] * 50 + [0, 0], 60, 20, 70),
    "closes_at_end_then_empty": ([10] * 20 + [0, 0], 50, 10, 60),
    "closes_at_end": ([10] * 20, 50, 10, 60),
    "all_empty": ([0] * 20, 50, 10, 60),
    "one_shard": ([1] * 20, 5000, 10, 6000),
    "no_minimum": ([random.Random(5).randint(0, 90) for _ in range(200)], 50, 0, 50),
    "single": ([70], 50, 10, 60),
    "many_giants": ([random.Random(6).choice([1, 4, 9, 9, 40, 700]) for _ in range(300)], 30, 10, 35),
}


@pytest.mark.parametrize("name", CASES)
def test_matches_sequential_rule(spark, name):
    check(spark, *CASES[name])


@pytest.mark.parametrize("partitions", [1, 8, 200])
def test_partition_count_does_not_matter(spark, partitions):
    rng = random.Random(9)
    sizes = [rng.randint(0, 100) for _ in range(500)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        check(spark, sizes, 150, 40, 180)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_narrow_lookup_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "LOOKUP_BUCKET_BYTES", 16)
    rng = random.Random(11)
    check(spark, [rng.choice([0, 1, 3, 50, 400]) for _ in range(400)], 120, 30, 150)


def test_offsets_beyond_double_precision(spark):
    big = 2**55
    check(spark, [big, 1, 1, big + 1, 3, 0, 5], 2**55, 2**50, 2**56)


def test_bad_limits(spark):
    with pytest.raises(ValueError):
        packing.assign_shards(make_index(spark, [1]), target=10, min_size=20, max_size=30)


def test_running_sums_with_one_hot_key(spark):
    rows = [("hot", i, i % 5) for i in range(3000)] + [(f"k{i:04d}", 0, 2) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, i long, v long").repartition(6)
    got = sorted(running_sums(df, ["k", "i"], {"total": "v", "n": None}).collect())
    total = 0
    for n, row in enumerate(got, 1):
        total += row.v
        assert (row.total, row.n) == (total, n)


def test_batch_ids_are_exact(spark):
    df = spark.range(2503).withColumnRenamed("id", "i")
    got = batch_ids(df, ["i"], 1000).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [tuple(r) for r in got] == [(0, 1000), (1, 1000), (2, 503)]


def test_prefix_sums_with_large_projects(spark, monkeypatch):
    """By project and in ranges alike; nulls, empty files and a project with a third of all files."""
    rng = random.Random(12)
    rows = [(rng.choice(["a", "a", "b", "c/d", "e", "f"]), f"f{i:04d}", rng.choice([0, 1, 7, 50, 400, None]), i) for i in range(600)]
    index = spark.createDataFrame(rows, "project_name string, file_path string, size long, tokens long")
    index = index.withColumn("sha256", F.lit("x")).withColumn("shard_id", F.lit(None).cast("string"))
    before, wanted = 0, {}
    for project, path, size, _ in sorted(rows, key=lambda r: r[:2]):
        wanted[project, path] = f"{before // 100:05d}"
        before += size or 0
    for limit in (10**6, 100, 0):
        monkeypatch.setattr(packing, "FILES_PER_WINDOW", limit)
        found = packing.assign_shards_prefix(index, target=100)
        assert {(r.project_name, r.file_path): r.shard_id for r in found.collect()} == wanted
    assert packing.assign_shards_prefix(index.limit(0), target=100).count() == 0
