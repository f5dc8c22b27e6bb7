"""Staged tables: written once to shared storage, so that later steps neither recompute nor
depend on executors that may be lost."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import get_ident

from pyspark.sql import DataFrame, SparkSession

from corpusmill import storage

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: Paths to delete at the end of each open scope, innermost last, of each thread, so that jobs in threads
#: do not delete each other's tables.
_SCOPES: dict[int, list[list[str]]] = {}


def staging_root(spark: SparkSession) -> str:
    """Shared folder the session names. Where driver and executors are one process (a local master)
    and none is named, a temporary folder becomes the session's checkpoint folder."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="corpusmill-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path no other run uses."""
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    if opened := _SCOPES.get(get_ident()):
        opened[-1].append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Deletes on leaving what this thread staged inside. What leaves the scope must be written elsewhere."""
    opened = _SCOPES.setdefault(get_ident(), [])
    opened.append([])
    try:
        yield
    finally:
        paths = opened.pop()
        if not opened:
            _SCOPES.pop(get_ident(), None)
        for path in paths:
            storage.delete(spark, path)


def stage(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return it read back."""
    path = new_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
