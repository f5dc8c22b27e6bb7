"""Search query texts, keys, URLs and name rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.constants import (
    BLOCKED_NAME_PARTS,
    CLONE_URL_PREFIX,
    CLONE_URL_SUFFIX,
    SEARCH_URL,
)


def fill(template: str | Column, **values: Column) -> Column:
    """Put column values in place of ``{name}`` marks."""
    start = F.lit(template) if isinstance(template, str) else template
    return reduce(
        lambda text, item: F.replace(text, F.lit("{" + item[0] + "}"), item[1].cast("string")),
        values.items(),
        start,
    )


def query_key(query: Column, sort: Column) -> Column:
    return F.concat_ws("|", query, sort)


def page_key(query: Column, sort: Column, order: Column, page: Column) -> Column:
    return F.concat_ws("|", query, sort, order, F.concat(F.lit("page"), page.cast("string")))


def search_url(query: Column, sort: Column, page: Column) -> Column:
    plus = F.replace(query, F.lit(" "), F.lit("+"))
    return fill(SEARCH_URL, sort=sort, page=page, query=plus)


def clone_url(full_name: Column) -> Column:
    return F.concat(F.lit(CLONE_URL_PREFIX), full_name, F.lit(CLONE_URL_SUFFIX))


def one_slash(name: Column) -> Column:
    return F.length(name) - F.length(F.replace(name, F.lit("/"), F.lit(""))) == 1


def not_blocked(name: Column) -> Column:
    blocked = [F.contains(name, F.lit(part)) for part in BLOCKED_NAME_PARTS]
    return ~reduce(lambda a, b: a | b, blocked)


def in_star_range(stars: Column, star_range: str) -> Column:
    """``>=a`` or ``a..b`` with both ends included."""
    if star_range.startswith(">="):
        return stars >= int(star_range[2:])
    low, high = star_range.split("..")
    return stars.between(int(low), int(high))
