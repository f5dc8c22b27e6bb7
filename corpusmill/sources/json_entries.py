"""Members of one large JSON object, read in splits of any size.

A summary document is one JSON object whose ``repos`` member may hold millions of projects, on one line
or on many. Each task takes a range of bytes. What it needs to know about the bytes before, whether
they end within a string, how deep, and within which member, is carried from split to split: a first pass
tells for each split where it would lead from either state of the quotes, which is one small row a split;
a second pass, knowing its start, hands out every member that begins in its range, reading on beyond it
to the end of the last one. Memory is one split and one member.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as Over

from corpusmill import staging
from corpusmill.storage import Clients

SPLIT_BYTES = 8 << 20
#: Splits that a task reads one after the other, about, if they are small.
SPLITS_PER_TASK = 500
QUOTE, BACKSLASH, COMMA = 0x22, 0x5C, 0x2C
WHITE = b" \t\r\n"
MEMBERS = "file string, split long, at long, depth int, parent string, name string, value string, sound boolean"


class Scan(NamedTuple):
    """Of a stretch of bytes: where unescaped quotes are, and at every byte whether it is outside of
    strings and how deep it is, brackets counted on opening and still on closing."""

    quotes: np.ndarray
    outside: np.ndarray
    depth: np.ndarray


def unescaped(data: np.ndarray, slashes: int) -> np.ndarray:
    """Places of quotes that no backslash escapes; ``slashes`` of them stand in front of the data."""
    quotes = np.flatnonzero(data == QUOTE)
    if not len(quotes):
        return quotes
    other = np.flatnonzero(data != BACKSLASH)
    before = np.searchsorted(other, quotes) - 1  # the last byte in front that is no backslash
    run = np.where(before >= 0, quotes - other[np.maximum(before, 0)] - 1, quotes + slashes)
    return quotes[run % 2 == 0]


def scan(data: np.ndarray, within: bool, depth: int, slashes: int) -> Scan:
    quotes = unescaped(data, slashes)
    turns = np.zeros(len(data) + 1, np.int8)
    turns[quotes] = 1
    inside = (np.cumsum(turns[:-1]) + within) % 2 == 1  # from an opening quote to before its closing one
    outside = ~inside
    outside[quotes] = False
    opens = outside & ((data == ord("{")) | (data == ord("[")))
    closes = outside & ((data == ord("}")) | (data == ord("]")))
    change = opens.astype(np.int32) - closes.astype(np.int32)
    deep = depth + np.cumsum(change, dtype=np.int32) + closes
    return Scan(quotes, outside, deep)


def bytes_of(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def effect(data: bytes, slashes: int) -> list[tuple[bool, int]]:
    """For a start outside and within a string: whether the data end within one, and the change of depth."""
    raw, out = bytes_of(data), []
    for within in (False, True):
        found = scan(raw, within, 0, slashes)
        ends = (len(found.quotes) + within) % 2 == 1
        last = int(found.depth[-1]) - int(found.outside[-1] and raw[-1] in b"}]") if len(raw) else 0
        out.append((ends, last))
    return out


class Window:
    """A range of a file, and what follows it as far as it is asked for."""

    def __init__(self, file, start: int, stop: int):
        self.file, self.start, self.stop = file, start, stop
        self.size = file.size()
        self.data = file.read_at(max(0, min(stop, self.size) - start), start)

    def slashes(self) -> int:
        """Backslashes right in front of the range."""
        count, low = 0, self.start
        while low > 0:
            part = self.file.read_at(min(64, low), max(0, low - 64))
            run = len(part) - len(part.rstrip(b"\\"))
            count += run
            if run < len(part):
                break
            low -= len(part)
        return count

    def more(self) -> bool:
        """Take in as much again; false at the end of the file."""
        at = self.start + len(self.data)
        extra = self.file.read_at(min(max(len(self.data), 4096), self.size - at), at) if at < self.size else b""
        self.data += extra
        return bool(extra)


class Member(NamedTuple):
    """A member that begins in a split: its place, its depth, and its text (None: a container that is
    looked into)."""

    at: int
    depth: int
    name: str
    value: str | None
    sound: bool


def members(window: Window, within: bool, depth: int, deepest: int) -> Iterator[Member]:
    """Members of objects at depths 1 to ``deepest`` whose names begin in the window's range."""
    length, slashes = len(window.data), window.slashes()
    while True:  # again with more bytes whenever a member goes on beyond what is there
        raw = bytes_of(window.data)
        found = scan(raw, within, depth, slashes)
        opening = found.quotes[int(within) :: 2]
        closing = found.quotes[int(within) + 1 :: 2].tolist()
        every = np.flatnonzero(found.outside & ((raw == COMMA) | (raw == ord("}"))))
        ends = {level: every[found.depth[every] == level] for level in range(1, deepest + 1)}
        out, short = [], False
        starts = opening[opening < length]
        levels = found.depth[starts]
        for i, (at, level) in enumerate(zip(starts.tolist(), levels.tolist(), strict=True)):
            if not 1 <= level <= deepest:
                continue
            if i >= len(closing):
                short = True
                break
            after = closing[i] + 1
            while after < len(raw) and raw[after] in WHITE:
                after += 1
            if after == len(raw):
                short = True
                break
            if raw[after] != ord(":"):
                continue
            value = after + 1
            while value < len(raw) and raw[value] in WHITE:
                value += 1
            if value == len(raw):
                short = True
                break
            name, sound = text_of(window.data[at : closing[i] + 1])
            if level < deepest and raw[value] in b"{[":
                out.append(Member(window.start + at, level, name or "", None, sound))
                continue
            later = np.searchsorted(ends[level], value)
            if later == len(ends[level]):
                short = True
                break
            body = window.data[value : ends[level][later]].strip(WHITE)
            try:
                json.loads(body)
                good = sound
            except ValueError:
                good = False
            out.append(Member(window.start + at, level, name or "", body.decode("utf-8", "replace"), good))
        if not short:
            yield from out
            return
        if not window.more():
            yield from out
            yield Member(window.start, 0, "", None, False)  # the document ends within a member
            return


def text_of(quoted: bytes) -> tuple[str | None, bool]:
    try:
        return json.loads(quoted), True
    except ValueError:
        return None, False


def read_members(spark: SparkSession, path: str, deepest: int = 2, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``file, split, at, depth, parent, name, value, sound`` (staged) of the members at depths 1 to
    ``deepest`` of the documents at ``path``, one object in each file.

    ``value`` is the member's JSON text, null where it is a container above ``deepest``; ``parent`` is the
    name of the member at depth 1 that holds it. A row of depth 0 that is not ``sound`` says that a
    document is cut short or does not close; other rows that are not sound have a value that is no JSON.
    """
    listed = spark.read.format("binaryFile").load(path).select("path", "length")
    count = F.greatest(F.lit(1), F.ceil(F.col("length") / split_bytes))
    splits = listed.select(F.col("path").alias("file"), "length", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)).alias("split"))
    splits = staging.stage(splits, "json-splits")
    held = F.least(F.lit(split_bytes), F.col("length") - F.col("split") * split_bytes)
    many, size = splits.agg(F.count("*"), F.coalesce(F.sum(held), F.lit(0))).first()
    tasks = max(spark.sparkContext.defaultParallelism, size // SPLIT_BYTES, many // SPLITS_PER_TASK)
    tasks = max(1, min(many, tasks))

    def opened(batches):
        clients = Clients()
        for batch in batches:
            for row in batch.to_pylist():
                system, inner = clients.at(row["file"])
                with system.open_input_file(inner) as file:
                    start = row["split"] * split_bytes
                    yield row, Window(file, start, start + split_bytes)

    def measure(batches):
        for row, window in opened(batches):
            (plain_ends, plain_depth), (quoted_ends, quoted_depth) = effect(window.data, window.slashes())
            yield pa.RecordBatch.from_pylist(
                [{"file": row["file"], "split": row["split"], "ends": [plain_ends, quoted_ends], "steps": [plain_depth, quoted_depth]}]
            )

    spread = splits.repartition(tasks, "file", "split")
    measured = spread.mapInArrow(measure, "file string, split long, ends array<boolean>, steps array<long>")
    order = Over.partitionBy("file").orderBy("split")  # a small row for each split
    before = order.rowsBetween(Over.unboundedPreceding, -1)
    # quotes turn either state of a split's start into the other or neither
    turned = F.sum(F.col("ends")[0].cast("bigint")).over(before)
    begun = measured.withColumn("within", F.coalesce(turned, F.lit(0)) % 2 == 1)
    begun = begun.withColumn("step", F.when(F.col("within"), F.col("steps")[1]).otherwise(F.col("steps")[0]))
    begun = begun.withColumn("depth", F.coalesce(F.sum("step").over(before), F.lit(0)))
    ends = F.col("within") != F.col("ends")[0]
    begun = begun.select("file", "split", "within", "depth", (ends | (F.col("depth") + F.col("step") != 0)).alias("open"))
    begun = staging.stage(begun, "json-states")
    open_ = begun.groupBy("file").agg(F.max_by("open", "split").alias("open")).where("open")
    open_ = open_.selectExpr(
        "file", "0L AS split", "0L AS at", "0 AS depth", "CAST(NULL AS string) AS parent", "'' AS name", "CAST(NULL AS string) AS value", "false AS sound"
    )

    def cut(batches):
        for row, window in opened(batches):
            parent, rows = None, []
            for m in members(window, row["within"], row["depth"], deepest):
                if m.depth == 1:
                    parent = m.name
                own = None if m.depth == 1 else parent
                rows.append((row["file"], row["split"], m.at, m.depth, own, m.name, m.value, m.sound))
            if rows:
                yield pa.RecordBatch.from_pydict({n: list(c) for n, c in zip(_NAMES, zip(*rows, strict=True), strict=True)}, _ARROW)

    found = staging.stage(begun.repartition(tasks, "file", "split").mapInArrow(cut, MEMBERS), "json-members")
    last = found.where("depth = 1").groupBy("file", "split").agg(F.max_by("name", "at").alias("last"))
    carried = begun.select("file", "split").join(last, ["file", "split"], "left")
    carried = carried.select("file", "split", F.last("last", ignorenulls=True).over(before).alias("before"))
    whole = found.join(carried, ["file", "split"]).withColumn(
        "parent", F.when(F.col("depth") > 1, F.coalesce("parent", "before")).otherwise(F.col("parent"))
    )
    return whole.drop("before").unionByName(open_)


_NAMES = [c.split()[0] for c in MEMBERS.split(", ")]
_ARROW = pa.schema(
    list(zip(_NAMES, [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_()], strict=True))
)
