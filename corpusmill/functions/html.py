"""Records in landed search pages, worked out inside the row: no shuffle."""

from __future__ import annotations

import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.constants import (
    CONTEXT_AFTER,
    CONTEXT_BEFORE,
    RECORD_PATTERN,
    SCRAPE_PAGE_RECORDS,
    STARS_LABEL_PATTERN,
    STARS_SPAN_PATTERN,
)
from corpusmill.functions.search import not_blocked, one_slash


def _label(context: Column) -> Column:
    return F.regexp_extract(context, STARS_LABEL_PATTERN, 1)


def _span(context: Column) -> Column:
    return F.lower(F.regexp_extract(context, STARS_SPAN_PATTERN, 1))


def _stars(label: Column, span: Column) -> Column:
    number = F.regexp_replace(span, "[km]", "").try_cast("double")
    factor = (
        F.when(F.endswith(span, F.lit("k")), 1e3).when(F.endswith(span, F.lit("m")), 1e6).otherwise(1.0)
    )
    spanned = (number * factor).cast("long")
    zero = F.lit(0).cast("long")
    return F.coalesce(F.nullif(label.try_cast("long"), zero), spanned, zero)


def parse_stars(context: Column) -> Column:
    """Whole number in the aria label first, else ``12``, ``1.2k`` or ``3m`` in the span."""
    return _stars(_label(context), _span(context))


def context_of(html: Column, match: Column) -> Column:
    """Text around a match, which may reach into the neighbouring records."""
    start = F.greatest(match["start"] - F.lit(CONTEXT_BEFORE), F.lit(0))
    return F.substring(html, start + 1, match["end"] + F.lit(CONTEXT_AFTER) - start)


MATCHES = "array<struct<position:int,name:string,start:int,end:int>>"


def _matcher(pattern: str):
    """Arrow function: all matches of a text, found in one pass."""

    @F.arrow_udf(MATCHES)
    def matches(texts: pa.Array) -> pa.Array:
        find = re.compile(pattern).finditer
        found = [None if t is None else [(m[1], m.start(), m.end()) for m in find(t)] for t in texts.to_pylist()]
        counts = [0 if f is None else len(f) for f in found]
        names, starts, ends = zip(*(x for f in found for x in f or ()), strict=True) if any(counts) else ((), (), ())
        rows = pa.StructArray.from_arrays(
            [
                pa.array([i for n in counts for i in range(n)], pa.int32()),
                pa.array(names, pa.string()),
                pa.array(starts, pa.int32()),
                pa.array(ends, pa.int32()),
            ],
            names=["position", "name", "start", "end"],
        )
        edges = list(accumulate(counts, initial=0))
        missing = pa.array([f is None for f in found], pa.bool_())
        return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), rows, mask=missing)

    return matches


def with_matches(pages: DataFrame, html: str = "html", pattern: str = RECORD_PATTERN) -> DataFrame:
    """Add ``matches``: ``position, name, start, end`` of each match in page order, the first group as
    its name; offsets count characters from 0. One pass in Python: in the JVM it takes three
    expressions over the page, and offsets that cost the square of the number of matches."""
    return pages.withColumn("matches", _matcher(pattern)(F.col(html)))


def record_array(html: Column, found: Column) -> Column:
    """Array of ``(position, name, stars)`` of every match in page order."""

    def texts(m: Column) -> Column:
        around = context_of(html, m)
        return F.struct(
            m["position"].alias("position"),
            m["name"].alias("name"),
            _label(around).alias("label"),
            _span(around).alias("span"),
        )

    return F.transform(
        F.transform(found, texts),
        lambda t: F.struct(
            t["position"].alias("position"),
            t["name"].alias("name"),
            _stars(t["label"], t["span"]).alias("stars"),
        ),
    )


def accepted(found: Column, limit: int = SCRAPE_PAGE_RECORDS) -> Column:
    """First ``limit`` distinct acceptable names of a page.

    A name is used up only by an occurrence that is accepted, so a rejected occurrence does
    not hide a later good one.
    """
    good = F.filter(
        found, lambda r: one_slash(r["name"]) & (r["stars"] > 0) & not_blocked(r["name"])
    )
    first = F.aggregate(
        good,
        F.array().cast("array<struct<position:int,name:string,stars:bigint>>"),
        lambda kept, r: F.when(
            F.array_contains(kept["name"], r["name"]), kept
        ).otherwise(F.concat(kept, F.array(r))),
    )
    return F.slice(first, 1, limit)
