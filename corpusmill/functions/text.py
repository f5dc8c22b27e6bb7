"""Strict and lossy readings of file bytes. The two are separate on purpose: the strict one
rejects what the lossy one repairs, and only the lossy one translates line ends."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.constants import MAX_CONTENT_CHARS

_REPLACEMENT = "�"
_ESCAPE = "\u0001"


def has_nul(content: Column) -> Column:
    return F.contains(content, F.unhex(F.lit("00")))


def is_utf8(content: Column) -> Column:
    return F.is_valid_utf8(content.cast("string"))


def is_strict_text(content: Column) -> Column:
    """No NUL byte and valid UTF-8 throughout."""
    return ~has_nul(content) & is_utf8(content)


def sha256_hex(content: Column) -> Column:
    return F.sha2(content, 256)


def drop_invalid_utf8(content: Column) -> Column:
    """Decode, leaving out the bytes that are not UTF-8.

    ``make_valid_utf8`` marks bad bytes with U+FFFD, so marks already in the text are escaped
    before and restored after.
    """
    raw = content.cast("string")
    esc, mark = F.lit(_ESCAPE), F.lit(_REPLACEMENT)
    escaped = F.replace(F.replace(raw, esc, F.lit(_ESCAPE + "a")), mark, F.lit(_ESCAPE + "b"))
    cleaned = F.replace(F.make_valid_utf8(escaped), mark, F.lit(""))
    restored = F.replace(F.replace(cleaned, F.lit(_ESCAPE + "b"), mark), F.lit(_ESCAPE + "a"), esc)
    return F.when(F.is_valid_utf8(raw), raw).otherwise(restored)


def translate_newlines(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text)


def lossy_text(content: Column) -> Column:
    return translate_newlines(drop_invalid_utf8(content))


def truncate(text: Column, max_chars: int = MAX_CONTENT_CHARS) -> Column:
    """Over-long content is cut (token counter)."""
    return F.substring(text, 1, max_chars)


def within_length(text: Column, max_chars: int = MAX_CONTENT_CHARS) -> Column:
    """Over-long content is left out (repository statistics)."""
    return F.length(text) <= F.lit(max_chars)
