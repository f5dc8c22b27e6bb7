"""How the operators run over tables of texts: Arrow batches in, one result per row out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a task looks at together; a longer text is looked at alone.
SLICE_BYTES = 4 << 20
#: Bytes of rows that Spark hands to a task's function together. Unless it is set, that is 10,000 rows of any size,
#: which the executor's JVM and the worker hold beside its heap.
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Takes texts (never null) and returns one Arrow array for each result field.
Compute = Callable[[list[str]], dict[str, pa.Array]]


def slices(
    batches: Iterable[pa.RecordBatch], sizes_of: Callable[[pa.RecordBatch], pa.Array], most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``most`` bytes of what ``sizes_of`` names, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(sizes_of(batch)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        window = (np.cumsum(sizes) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(window)) + 1).tolist(), len(sizes)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if high > low:
                yield batch.slice(low, high - low)


def bound_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on hands on batches of about ``SLICE_BYTES`` (or one row), unless it names
    a size itself."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_CONF, None) is None:
        conf.set(BATCH_CONF, str(SLICE_BYTES))
    return df


def annotate(
    df: DataFrame,
    start: Callable[[], Compute],
    fields: T.StructType,
    text: str = "text",
    keep: list[str] | None = None,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Two columns, ``row`` (the input's columns, or those in ``keep``) and ``result`` (``fields``).

    ``start`` runs once per task and returns what is applied to each slice of texts. A null text
    is handed over as an empty one. As both columns are structs, no name of the input can clash
    with a name of the result.
    """
    kept = T.StructType([f for f in df.schema.fields if keep is None or f.name in keep])
    wanted = list(dict.fromkeys([*([c.name for c in kept]), text]))
    packed = bound_batches(df).select(F.struct(*(F.col(f"`{c}`") for c in wanted)).alias("row"))
    names, text_at = [f.name for f in fields], wanted.index(text)
    places = [wanted.index(f.name) for f in kept]
    whole = len(kept) == len(wanted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in slices(batches, lambda b: b.column(0).field(text_at), slice_bytes):
            row = batch.column(0)
            found = compute([t or "" for t in row.field(text_at).to_pylist()])
            if not whole:
                children = [row.field(i) for i in places]
                row = pa.StructArray.from_arrays(children, fields=[row.type.field(i) for i in places])
            result = pa.StructArray.from_arrays([found[n] for n in names], names=names)
            yield pa.RecordBatch.from_arrays([row, result], names=["row", "result"])

    return packed.mapInArrow(run, T.StructType([T.StructField("row", kept), T.StructField("result", fields)]))


LONG, TEXT, REAL, FLAG = T.LongType(), T.StringType(), T.DoubleType(), T.BooleanType()


def struct(**kinds: T.DataType) -> T.StructType:
    """A struct type from names and types."""
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def span(**kinds: T.DataType) -> T.ArrayType:
    """An array of structs."""
    return T.ArrayType(struct(**kinds))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``starts[i] .. starts[i] + lengths[i] - 1``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def offsets(lengths: np.ndarray) -> np.ndarray:
    """Where each of the consecutive pieces starts, and where the last one ends."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def table(spark, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")
