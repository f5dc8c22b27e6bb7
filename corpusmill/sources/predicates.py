"""Predicates that Spark pushes into a data source, evaluated on rows held as dictionaries."""

from __future__ import annotations

from pyspark.sql.datasource import (
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)

_COMPARED = {
    GreaterThan: lambda own, value: own > value,
    GreaterThanOrEqual: lambda own, value: own >= value,
    LessThan: lambda own, value: own < value,
    LessThanOrEqual: lambda own, value: own <= value,
}
_MATCHED = {
    EqualTo: lambda own, value: own == value,
    StringStartsWith: str.startswith,
    StringEndsWith: str.endswith,
    StringContains: str.__contains__,
}


def decidable(f: Filter, columns: set[str], numbers: set[str]) -> bool:
    """Whether a predicate is about one of ``columns`` and one of those below. Orders of texts are left
    to Spark, which compares bytes."""
    while isinstance(f, Not):
        f = f.child
    if len(getattr(f, "attribute", ())) != 1 or f.attribute[0] not in columns:
        return False
    if type(f) in _COMPARED:
        return f.attribute[0] in numbers
    return isinstance(f, (In, IsNull, IsNotNull, EqualNullSafe)) or type(f) in _MATCHED


def verdict(f: Filter, row: dict[str, object]) -> bool | None:
    """True, False, or None for unknown, as in SQL."""
    if isinstance(f, Not):
        inner = verdict(f.child, row)
        return None if inner is None else not inner
    own = row[f.attribute[0]]
    if isinstance(f, IsNull):
        return own is None
    if isinstance(f, IsNotNull):
        return own is not None
    if isinstance(f, EqualNullSafe):
        return own == f.value
    if own is None:
        return None
    if isinstance(f, In):
        return True if own in f.value else None if None in f.value else False
    if f.value is None:
        return None
    return (_COMPARED.get(type(f)) or _MATCHED[type(f)])(own, f.value)


def meets(filters: list[Filter], row: dict[str, object]) -> bool:
    return all(verdict(f, row) is True for f in filters)


def may_hold(f: Filter, column: str, prefix: str) -> bool:
    """Whether a text ``column`` that starts with ``prefix`` can meet the predicate at all; true where
    that cannot be told."""
    if isinstance(f, Not):
        inner = f.child
        if isinstance(inner, StringContains) and inner.attribute == (column,):
            return inner.value is not None and inner.value not in prefix
        if isinstance(inner, StringStartsWith) and inner.attribute == (column,):
            return inner.value is not None and not prefix.startswith(inner.value)
        return True
    if getattr(f, "attribute", None) != (column,):
        return True
    if isinstance(f, (EqualTo, EqualNullSafe)):
        return f.value is not None and f.value.startswith(prefix)
    if isinstance(f, In):
        return any(v is not None and v.startswith(prefix) for v in f.value)
    if isinstance(f, StringStartsWith):
        return f.value is not None and (f.value.startswith(prefix) or prefix.startswith(f.value))
    return not isinstance(f, IsNull)
