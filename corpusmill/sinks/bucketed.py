"""Seen tables in buckets of their key, so that asking them costs a shuffle of the new rows only.

A table is Parquet in Spark's bucketed layout at a path of its own, with a note beside it of its key,
buckets and columns. A session registers it by its path, whoever wrote it.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from corpusmill import staging, storage


def _note(path: str) -> str:
    return f"{path}.layout"


def _name(path: str) -> str:
    return f"bucketed_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def create(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write ``df`` as a new table at ``path``. A bucket should hold some 100 MiB at most."""
    spark, path = df.sparkSession, storage.qualified(df.sparkSession, path)
    note = json.dumps({"key": key, "buckets": buckets, "schema": df.schema.jsonValue()})
    spark.createDataFrame([(note,)], "value string").coalesce(1).write.text(_note(path))
    _append(df, path, key, buckets)


def _append(df: DataFrame, path: str, key: str, buckets: int) -> None:
    dealt = df.repartition(buckets, key)  # a task writes one bucket
    writer = dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).mode("append")
    writer.option("path", path).saveAsTable(_name(path))


def layout(spark: SparkSession, path: str) -> tuple[str, int, T.StructType]:
    """Key, number of buckets and columns of a table."""
    note = json.loads(spark.read.text(_note(path)).first().value)
    return note["key"], note["buckets"], T.StructType.fromJson(note["schema"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` as it is now."""
    path = storage.qualified(spark, path)
    key, buckets, schema = layout(spark, path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_name(path)} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    spark.catalog.refreshTable(_name(path))
    return spark.table(_name(path))


def unseen(rows: DataFrame, *paths: str) -> DataFrame:
    """Rows whose key is in none of the tables, which share key and buckets. ``rows`` are dealt to the
    buckets once; the tables stay where they are."""
    spark = rows.sparkSession
    layouts = {layout(spark, storage.qualified(spark, p))[:2] for p in paths}
    if len(layouts) != 1:
        raise ValueError(f"tables differ in key or buckets: {sorted(layouts)}")
    ((key, buckets),) = layouts
    left = rows.repartition(buckets, key)
    for path in paths:
        left = left.join(read(spark, path).select(key).hint("merge"), key, "left_anti")
    return left.select(*rows.columns)


def add_unseen(rows: DataFrame, path: str) -> DataFrame:
    """Append the rows whose key the table lacks, one for each key should be given; returns them. Adding
    the same rows again adds nothing."""
    spark, path = rows.sparkSession, storage.qualified(rows.sparkSession, path)
    key, buckets, _ = layout(spark, path)
    new = staging.stage(unseen(rows, path), "unseen")
    _append(new, path, key, buckets)
    return new
