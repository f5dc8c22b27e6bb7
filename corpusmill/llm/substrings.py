"""Substring deduplication by hashing lines.

Every line is a unit, and so is every sentence of a line that has several (a passage that was
pasted into a line is found by its sentences) and every paragraph of several lines, which are those
between lines without words (a passage that was wrapped into short lines is found by it). Units are
normalised (lower case, white space runs as one space), digests are grouped over the whole corpus,
the occurrence ranked first stays and every later one is removed. Ranks go by document id, then by
place in the document. Lines and paragraphs count however short they are, if they have a character
besides white space; a sentence within a line counts from ``sentence_chars`` such characters on, as
shorter ones ("So he said.") repeat by chance in lines that do not. Words are not counted, as some
scripts write none.

Digests are grouped with partial aggregation to the first occurrence and a count; only digests that
come twice or more meet their occurrences again, the hot ones without a shuffle. Removed stretches
keep their offsets in the original text (code points, exclusive ends).

Defined results: a null text stays null and an empty one empty, both with nothing removed; texts of
any length are looked at whole; of rows with equal ids (and of rows with null ids, ranked last) the
one whose text hashes lower comes first, and rows with equal id and text share their fate; an
empty table gives an empty table. Other columns are left alone.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill import staging
from corpusmill.llm import common, skew

#: Characters besides white space that a sentence within a line has at least.
SENTENCE_CHARS = 10
SENTENCE_END = re.compile(r"[.!?…][\"'”’)\]]*(?=\s)|[。！？]")
SPANS = common.span(start=common.LONG, end=common.LONG)
SPAN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def sentences(line: str, offset: int) -> list[tuple[int, int]]:
    """Where the sentences of a line start and end; together they cover the line."""
    ends = [m.end() for m in SENTENCE_END.finditer(line)]
    if not ends or ends[-1] < len(line):
        ends.append(len(line))
    out, start = [], 0
    for end in ends:
        out.append((offset + start, offset + end))
        start = end
    return out


def units(text: str, sentence_chars: int = SENTENCE_CHARS) -> list[tuple[int, int, int]]:
    """``(start, end, digest)`` of every unit of a text, in order of their start and end."""
    out = []
    at = 0
    paragraph: list[str] = []
    first = last = lines = 0

    for line in [*text.split("\n"), ""]:
        words = line.lower().split()
        if words:
            out.append((at, at + len(line), digest(words)))
            parts = sentences(line, at)
            if len(parts) > 1:
                for start, end in parts:
                    own = text[start:end].lower().split()
                    if own and sum(map(len, own)) >= sentence_chars:
                        out.append((start, end, digest(own)))
            first = first if lines else at
            last, lines = at + len(line), lines + 1
            paragraph += words
        elif lines:
            if lines > 1:
                out.append((first, last, digest(paragraph)))
            paragraph, lines = [], 0
        at += len(line) + 1
    return sorted(out)


def digest(words: list[str]) -> int:
    value = xxhash.xxh3_64_intdigest(" ".join(words).encode())
    return value - (1 << 64) if value >> 63 else value


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` with the spans cut out; a line that loses all its words loses its line end too."""
    kept, at = [], 0
    for start, end in spans:
        if (start == 0 or text[start - 1] == "\n") and text[end : end + 1] == "\n":
            end += 1
        kept.append(text[at : max(start, at)])
        at = max(at, end)
    return "".join([*kept, text[at:]])


def find_units(rows: DataFrame, sentence_chars: int = SENTENCE_CHARS) -> DataFrame:
    """``digest, id, copy, start, end`` of all units of ``rows`` (``id, copy, text``)."""

    def run(batches):
        for batch in common.slices(batches, lambda b: b.column(2)):
            found = [units(t or "", sentence_chars) for t in batch.column(2).to_pylist()]
            owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
            flat = [u for f in found for u in f]
            yield pa.RecordBatch.from_pydict(
                {
                    "digest": pa.array([u[2] for u in flat], pa.int64()),
                    "id": batch.column(0).take(pa.array(owner)),
                    "copy": batch.column(1).take(pa.array(owner)),
                    "start": pa.array([u[0] for u in flat], pa.int64()),
                    "end": pa.array([u[1] for u in flat], pa.int64()),
                }
            )

    fields = [T.StructField("digest", common.LONG), *rows.schema.fields[:2]]
    fields += [T.StructField("start", common.LONG), T.StructField("end", common.LONG)]
    return rows.mapInArrow(run, T.StructType(fields))


def repeated_spans(rows: DataFrame, sentence_chars: int = SENTENCE_CHARS) -> DataFrame:
    """``id, copy, spans``: the units of each row that came before, in this row or an earlier one."""
    found = staging.stage(find_units(rows, sentence_chars), "substring-units")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "copy", "start", F.col("end").alias("end"))
    grouped = found.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    facts = staging.stage(grouped, "substring-digests")
    total = facts.agg(F.sum("n")).first()[0] or 0
    later = skew.attach(found, facts, "digest", total, "inner").where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("id", "copy").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def remove_repeats(
    df: DataFrame, text: str = "text", id: str = "doc_id", sentence_chars: int = SENTENCE_CHARS
) -> DataFrame:
    """``row`` (all columns), ``kept`` (the text without repeats) and ``removed`` (spans of the
    original text, merged)."""
    named = df.select(
        F.col(f"`{id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("copy"), F.col(f"`{text}`").alias("text"), F.struct("*").alias("row")
    )
    spans = repeated_spans(named.select("id", "copy", "text"), sentence_chars)
    same = F.col("id").eqNullSafe(F.col("its_id")) & (F.col("copy") == F.col("its_copy"))
    renamed = spans.select(F.col("id").alias("its_id"), F.col("copy").alias("its_copy"), "spans")
    joined = named.drop("text").join(renamed, same, "left").select("row", "spans")
    row_type = joined.schema["row"].dataType
    text_at = row_type.names.index(text)

    def run(batches):
        for batch in common.slices(batches, lambda b: b.column(0).field(text_at)):
            texts, found = batch.column(0).field(text_at).to_pylist(), batch.column(1).to_pylist()
            kept, removed = [], []
            for value, own in zip(texts, found, strict=True):
                cut = merged([(s["start"], s["end"]) for s in own or []])
                kept.append(without(value, cut) if cut else value)
                removed.append([{"start": a, "end": b} for a, b in cut])
            columns = [batch.column(0), pa.array(kept, pa.string()), pa.array(removed, SPAN_ARROW)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "kept", "removed"])

    fields = T.StructType([T.StructField("row", row_type), T.StructField("kept", common.TEXT), T.StructField("removed", SPANS)])
    return joined.mapInArrow(run, fields)
