"""Parts of text keys. Plain text search throughout, so no regular expression runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_head(key: Column, length: int, separator: str = "-", written_as: str = "_") -> Column:
    """The first ``length`` characters of a composite key, its separators rewritten."""
    return F.replace(F.substring(key, 1, length), F.lit(separator), F.lit(written_as))


def key_tail(key: Column, start: int) -> Column:
    """A composite key from character ``start`` (counted from 1) on; empty when the key ends before it."""
    return F.substr(key, F.lit(start))


def strip_prefix(text: Column, prefix: str) -> Column:
    """Text without a known prefix; text that does not start with it is left alone."""
    return F.when(text.startswith(prefix), key_tail(text, len(prefix) + 1)).otherwise(text)


def remove_text(text: Column, removed: str) -> Column:
    """Text without any occurrence of ``removed``."""
    return F.replace(text, F.lit(removed), F.lit(""))
