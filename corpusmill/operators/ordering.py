"""Running sums over a total order without a single-task window.

Rows are range-partitioned and sorted once, summed within each range, and shifted by the totals
of the ranges before it. Ranges split hot keys wherever the sort columns differ, so the order
columns should identify a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill import staging

RANGE = "_range"
ROWS_PER_RANGE = 2_000_000


def _accumulate(sources: list[str | None]):
    """Arrow function: append the range number and running sums of a sorted partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = [0] * len(sources)
        part = TaskContext.get().partitionId()
        for batch in batches:
            columns, names = list(batch.columns), list(batch.schema.names)
            columns.append(pa.array(np.full(batch.num_rows, part, dtype=np.int32)))
            names.append(RANGE)
            for i, source in enumerate(sources):
                if source is None:
                    values = np.ones(batch.num_rows, dtype=np.int64)
                else:
                    filled = pc.fill_null(batch.column(names.index(source)), 0)
                    values = filled.to_numpy(zero_copy_only=False).astype(np.int64)
                running = np.cumsum(values) + carried[i]
                if batch.num_rows:
                    carried[i] = int(running[-1])
                columns.append(pa.array(running))
                names.append(f"_running_{i}")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def running_sums(
    df: DataFrame, order_by: list[str | Column], sums: dict[str, str | None], *, rows: int | None = None
) -> DataFrame:
    """Add running sums, current row included, in the order of ``order_by``.

    ``sums`` maps a new column to the long column it adds up, or to None to count rows. The
    result is a staged table. ``df`` is read to be counted, for range bounds, and for its data, so
    stage it first if it is costly. ``rows`` saves the count if it is known.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    schema = T.StructType(
        df.schema.fields
        + [T.StructField(RANGE, T.IntegerType())]
        + [T.StructField(f"_running_{i}", T.LongType()) for i in range(len(sums))]
    )
    ranges = (df.count() if rows is None else rows) // ROWS_PER_RANGE
    if ranges > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        ranged = df.repartitionByRange(ranges, *order)
    else:
        ranged = df.repartitionByRange(*order)
    ranged = ranged.sortWithinPartitions(*order)
    staged = staging.stage(ranged.mapInArrow(_accumulate(list(sums.values())), schema), "running")
    # one row per range, so what the driver takes and broadcasts is bounded by the partition count
    per_range = staged.groupBy(RANGE).agg(
        *[F.count(F.lit(1)) if source is None else F.coalesce(F.sum(source), F.lit(0)) for source in sums.values()]
    )
    bases, before = [], [0] * len(sums)
    for number, *added in sorted(per_range.collect()):
        bases.append((number, *before))
        before = [b + a for b, a in zip(before, added)]
    layout = ", ".join([f"{RANGE} int", *[f"_base_{i} long" for i in range(len(sums))]])
    joined = staged.join(F.broadcast(df.sparkSession.createDataFrame(bases, layout)), RANGE)
    return joined.select(
        *df.columns,
        *[(F.col(f"_base_{i}") + F.col(f"_running_{i}")).alias(out) for i, out in enumerate(sums)],
    )


def canonical_order(index: DataFrame) -> DataFrame:
    """Files in the order shards are filled: project, then path, compared as bytes."""
    return index.orderBy("project_name", "file_path")


def batch_ids(df: DataFrame, order_by: list[str], rows_per_batch: int) -> DataFrame:
    """Number the rows from 1 and cut them into batches of exactly ``rows_per_batch``."""
    numbered = running_sums(df, order_by, {"row_number": None})
    return numbered.withColumn(
        "batch_id", F.floor((F.col("row_number") - 1) / F.lit(rows_per_batch)).cast("long")
    )
