"""Keyed tables that an update rewrites in part: copy on write by buckets of the key.

A version is a small note that says for each bucket which folder holds it. An update reads and writes the
buckets of its own keys only, into folders of its own, and then adds the note of the next version; until
then, and if it fails before, readers see the version before. Notes are created, never replaced, so of
two updates from one version the second fails.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill import storage

BUCKET = "_bucket"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _notes(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def version(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and note of the current version; a note cut short by a crash does not count."""
    path = storage.qualified(spark, path)
    system, folder = _notes(spark, path)
    found = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
    for number in sorted((int(n[:-5]) for n in found if re.fullmatch(r"\d+\.json", n)), reverse=True):
        lines = [r.value for r in spark.read.text(f"{path}/versions/{number:08d}.json").collect()]
        if len(lines) == 2 and lines[1] == "complete":
            return number, json.loads(lines[0])
    raise FileNotFoundError(f"no version of a table at {path}")


def _publish(spark: SparkSession, path: str, number: int, note: dict) -> None:
    system, folder = _notes(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:08d}.json")
    try:
        out = system.create(target, False)
    except Py4JJavaError as error:
        raise RuntimeError(f"version {number} of {path} was written by another update") from error
    out.write(bytearray(f"{json.dumps(note)}\ncomplete\n".encode()))
    out.close()


def _write(rows: DataFrame, path: str, key: str, buckets: int, tasks: int) -> str:
    """Write ``rows`` into a new folder by buckets; returns its name."""
    folder = uuid.uuid4().hex
    parted = rows.withColumn(BUCKET, _bucket(key, buckets)).repartition(max(1, tasks), BUCKET)
    parted.write.partitionBy(BUCKET).parquet(f"{path}/data/{folder}")
    return folder


def create(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write ``df``, one row for each key, as the first version."""
    spark, path = df.sparkSession, storage.qualified(df.sparkSession, path)
    folder = _write(df, path, key, buckets, buckets)
    note = {"key": key, "buckets": buckets, "schema": df.schema.jsonValue(), "folders": [folder] * buckets}
    _publish(spark, path, 1, note)


def _folders(spark: SparkSession, path: str, note: dict, wanted: list[int]) -> DataFrame:
    schema = T.StructType.fromJson(note["schema"])
    system = _notes(spark, path)[0]
    places = [f"{path}/data/{note['folders'][b]}/{BUCKET}={b}" for b in wanted]
    there = [p for p in places if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p))]  # an empty bucket has no folder
    return spark.read.schema(schema).parquet(*there) if there else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The current version."""
    path = storage.qualified(spark, path)
    note = version(spark, path)[1]
    return _folders(spark, path, note, list(range(note["buckets"])))


def upsert(updates: DataFrame, path: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
    """The next version: buckets of the keys in ``updates`` (staged) hold what ``merge`` makes of their
    rows and the updates, the other buckets keep their files. Returns the buckets written."""
    spark, path = updates.sparkSession, storage.qualified(updates.sparkSession, path)
    number, note = version(spark, path)
    key, buckets = note["key"], note["buckets"]
    touched = sorted(r[0] for r in updates.select(_bucket(key, buckets)).distinct().collect())  # at most all buckets
    if not touched:
        return []
    merged = merge(_folders(spark, path, note, touched), updates)
    folder = _write(merged.select(*T.StructType.fromJson(note["schema"]).fieldNames()), path, key, buckets, len(touched))
    folders = [folder if b in set(touched) else old for b, old in enumerate(note["folders"])]
    _publish(spark, path, number + 1, note | {"folders": folders})
    return touched


def vacuum(spark: SparkSession, path: str) -> None:
    """Delete what the current version does not name. Nobody may be reading or writing others."""
    path = storage.qualified(spark, path)
    number, note = version(spark, path)
    system, folder = _notes(spark, path)
    data = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    for status in system.listStatus(data):
        name = status.getPath().getName()
        if name not in note["folders"]:
            storage.delete(spark, f"{path}/data/{name}")
            continue
        for part in system.listStatus(status.getPath()):
            bucket = re.fullmatch(rf"{BUCKET}=(\d+)", part.getPath().getName())
            if bucket and note["folders"][int(bucket[1])] != name:
                system.delete(part.getPath(), True)
    for status in system.listStatus(folder):
        if status.getPath().getName() != f"{number:08d}.json":
            system.delete(status.getPath(), True)
