"""Parquet and summary outputs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill import storage
from corpusmill.constants import CHUNK_ROWS
from corpusmill.operators.extract import conform
from corpusmill.operators.ordering import batch_ids
from corpusmill.operators.rollup import summary_lines
from corpusmill.schemas import FILE_CHUNK, INDEX


def write_chunks(metadata: DataFrame, path: str, *, rows_per_file: int = CHUNK_ROWS, exact: bool = False) -> None:
    """Metadata rows as Parquet chunks of at most ``rows_per_file`` rows.

    With ``exact`` the rows are numbered in canonical order and every chunk but the last has
    exactly that many, one folder ``batch_id=N`` each. No rows, no chunk.
    """
    rows = conform(metadata, FILE_CHUNK)
    if not exact:
        rows.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
        return
    order = ["project_name", "relative_path"]
    numbered = batch_ids(rows, order, rows_per_file).drop("row_number")
    spread = numbered.repartition("batch_id").sortWithinPartitions("batch_id", *order)
    spread.write.partitionBy("batch_id").parquet(path)


def write_index(index: DataFrame, path: str) -> DataFrame:
    """The global index as a table, read back. Packing and archiving both start from it."""
    conform(index, INDEX).write.parquet(path)
    return index.sparkSession.read.schema(INDEX).parquet(path)


def write_final(manifest: DataFrame, path: str) -> DataFrame:
    """All shard manifests as one table, read back. An earlier table stays until the new one is there."""
    spark = manifest.sparkSession
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    conform(manifest, INDEX).write.parquet(beside)
    storage.rename(spark, beside, path)
    return spark.read.schema(INDEX).parquet(path)


def write_summary(rollup: DataFrame, path: str, totals: DataFrame | None = None) -> None:
    """The summary document; its part files in name order are one JSON document. An earlier
    document stays until the new one is there."""
    lines = summary_lines(rollup, totals).orderBy("part", "project_name")
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    lines.select("line").write.text(beside)
    storage.rename(rollup.sparkSession, beside, path)


def update_summary(rollup: DataFrame, reconciled: DataFrame, path: str, *, update: bool) -> bool:
    """Rewrite the summary only if asked to and a total differs. ``reconciled`` has one row, or
    none if there is nothing to compare with; then nothing is written."""
    row = reconciled.select((F.col("tokens_match") & F.col("files_match")).alias("ok")).first()
    if row is None or row["ok"] or not update:
        return False
    write_summary(rollup, path)
    return True
