import pytest
from pyspark.sql import functions as F

from corpusmill import staging
from corpusmill.llm import sieve, skew


@pytest.mark.parametrize(("least", "most"), [(1 << 15, 1 << 27), (1 << 15, 1 << 15)])
def test_rows_in_and_out(spark, monkeypatch, least, most):
    """Exact with a wide filter and with one that is far too small for its ids; null keys are outside."""
    monkeypatch.setattr(sieve, "LEAST", least)
    monkeypatch.setattr(sieve, "MOST", most)
    rows = spark.range(0, 20_000).select(F.when(F.col("id") % 100 != 7, F.col("id") - 10_000).alias("key"), F.col("id").alias("n"))
    ids = staging.stage(spark.range(-12_000, 5_000, 3).select(F.col("id").alias("key")), "test-ids")
    wanted = set(range(-12_000, 5_000, 3))
    every = [(r.key, r.n) for r in rows.collect()]
    inside = {n for k, n in every if k in wanted}
    assert {r.n for r in sieve.among(rows, ids, "key").collect()} == inside
    left = [r.n for r in sieve.outside(rows, ids, "key").collect()]
    assert sorted(left) == sorted(n for _, n in every if n not in inside)
    marked = sieve.mark(rows, ids, "key", "maybe").where("maybe").count()
    assert len(inside) <= marked and (marked < len(inside) * 1.2 or most == 1 << 15)


def test_no_ids(spark):
    rows, none = spark.range(10).withColumnRenamed("id", "key"), staging.stage(spark.range(0).withColumnRenamed("id", "key"), "test-none")
    assert sieve.among(rows, none, "key").count() == 0 and sieve.outside(rows, none, "key").count() == 10


def test_rows_of_a_hot_key_are_dealt_to_parts(spark, monkeypatch):
    monkeypatch.setattr(skew, "TOGETHER", 50)
    rows = staging.stage(spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 40).alias("k"), F.col("id").alias("n")), "test-rows")
    dealt, parts = skew.deal(rows, "k", "n")
    facts = spark.range(40).select(F.col("id").cast("int").alias("k"), (F.col("id") * 7).alias("fact"))
    met = dealt.join(parts.join(facts, "k"), ["k", "part"])
    assert met.count() == 3000 and met.where("fact <> k * 7").isEmpty()
    assert met.groupBy("k", "part").count().agg(F.max("count")).first()[0] < 120
