"""Table operators: DataFrame in, DataFrame out, composed with ``DataFrame.transform``."""

from conform.operators.dedupe import dedupe_latest
from conform.operators.keys import gapless_key
from conform.operators.lookup import left_lookup, resolve_key
from conform.operators.select import current_only, project
from conform.operators.validity import close_validity

__all__ = [
    "close_validity",
    "current_only",
    "dedupe_latest",
    "gapless_key",
    "left_lookup",
    "project",
    "resolve_key",
]
