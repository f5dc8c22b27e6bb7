import os
import re

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import discovery as D
from corpusmill.operators import repo_stats
from corpusmill.sinks import bucketed, keyed


def plan_of(df):
    """The plan that runs, without the one it began as."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def exchanges(df):
    return re.findall(r"Exchange (\w+)", plan_of(df))


def test_asking_a_seen_table_shuffles_new_rows_only(spark, tmp_path):
    seen, cloned = str(tmp_path / "seen"), str(tmp_path / "cloned")
    bucketed.create(spark.range(0, 1000).select(F.col("id").alias("repo")), seen, "repo", 6)
    bucketed.create(spark.range(900, 1200).select(F.col("id").alias("repo"), F.lit("x").alias("name")), cloned, "repo", 6)
    new = spark.range(800, 1400).select(F.col("id").alias("repo"), (F.col("id") * 2).alias("n"))
    found = bucketed.unseen(new, seen, cloned)
    assert sorted(r.repo for r in found.collect()) == list(range(1200, 1400))
    assert exchanges(found) == ["hashpartitioning"] == exchanges(new.repartition(6, "repo"))
    assert plan_of(found).count("Bucketed: true") == 2


def test_a_seen_table_grows_once(spark, tmp_path):
    path = str(tmp_path / "seen")
    bucketed.create(spark.createDataFrame([("a", 1), ("b", 2)], "name string, n int"), path, "name", 3)
    rows = spark.createDataFrame([("b", 9), ("c", 3), ("é", 4)], "name string, n int")
    assert sorted(r.name for r in bucketed.add_unseen(rows, path).collect()) == ["c", "é"]
    assert bucketed.add_unseen(rows, path).count() == 0
    spark.sql(f"DROP TABLE {bucketed._name('file:' + path)}")  # another session registers it by its path
    assert {(r.name, r.n) for r in bucketed.read(spark, path).collect()} == {("a", 1), ("b", 2), ("c", 3), ("é", 4)}
    again = bucketed.unseen(D.first_seen(rows, "name", ["n"]), path)
    assert again.count() == 0 and exchanges(again).count("hashpartitioning") == 2  # first hits, and their way to the buckets


def test_other_layouts_are_refused(spark, tmp_path):
    for name, buckets in (("a", 2), ("b", 3)):
        bucketed.create(spark.range(5), str(tmp_path / name), "id", buckets)
    with pytest.raises(ValueError, match="differ"):
        bucketed.unseen(spark.range(9), str(tmp_path / "a"), str(tmp_path / "b"))


SCHEMA = "full_name string, cloned_at long, stars long"


def merge(old, new):
    return repo_stats.upsert_repos(old, new)


def files(path):
    return {p: os.stat(p).st_mtime_ns for d, _, names in os.walk(f"{path}/data") for n in names if n.endswith(".parquet") for p in [f"{d}/{n}"]}


def test_an_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "repos")
    rows = [(f"r/{i}", 1, i) for i in range(200)]
    keyed.create(spark.createDataFrame(rows, SCHEMA), path, "full_name", 16)
    before = files(path)
    updates = spark.createDataFrame([("r/5", 2, 500), ("r/7", 0, 700), ("new/one", 2, 1)], SCHEMA)
    touched = keyed.upsert(updates, path, merge)
    assert 1 <= len(touched) <= 3
    wanted = {n: s for n, _, s in rows} | {"r/5": 500, "new/one": 1}
    assert {r.full_name: r.stars for r in keyed.read(spark, path).collect()} == wanted
    assert {p: t for p, t in files(path).items() if p in before} == before  # nothing is replaced in place
    read = {r[0].removeprefix("file://") for r in keyed.read(spark, path).select(F.input_file_name()).distinct().collect()}
    kept = {p for p in before if int(re.search(r"_bucket=(\d+)", p)[1]) not in touched}
    assert kept <= read and len(read - kept) == len(touched)
    keyed.vacuum(spark, path)
    assert set(files(path)) == read and {r.full_name: r.stars for r in keyed.read(spark, path).collect()} == wanted


def test_a_failed_or_late_update_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "repos")
    keyed.create(spark.createDataFrame([("a", 1, 1)], SCHEMA), path, "full_name", 4)
    updates = spark.createDataFrame([("a", 2, 2), ("b", 2, 2)], SCHEMA)

    def broken(old, new):
        return merge(old, new).withColumn("stars", F.raise_error(F.lit("lost")).cast("long"))

    with pytest.raises(Exception, match="lost"):
        keyed.upsert(updates, path, broken)
    assert [tuple(r) for r in keyed.read(spark, path).collect()] == [("a", 1, 1)]

    def overtaken(old, new):
        keyed.upsert(new.filter("full_name = 'b'"), path, merge)
        return merge(old, new)

    with pytest.raises(RuntimeError, match="another update"):
        keyed.upsert(updates, path, overtaken)
    assert {r.full_name for r in keyed.read(spark, path).collect()} == {"a", "b"}
    (tmp_path / "repos" / "versions" / "00000009.json").write_text('{"key": "cut sho')
    assert keyed.version(spark, path)[0] == 2
    assert keyed.upsert(updates.limit(0), path, merge) == []
