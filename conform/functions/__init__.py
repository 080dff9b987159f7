"""Column rules: each takes columns and returns a column, never touching a DataFrame."""

from conform.functions.amounts import repaired_amount, repaired_price
from conform.functions.dates import last_day_before, null_after, packed_date
from conform.functions.labels import NOT_AVAILABLE, map_codes, prefer
from conform.functions.text import key_head, key_tail, remove_text, strip_prefix

__all__ = [
    "NOT_AVAILABLE",
    "key_head",
    "key_tail",
    "last_day_before",
    "map_codes",
    "null_after",
    "packed_date",
    "prefer",
    "remove_text",
    "repaired_amount",
    "repaired_price",
    "strip_prefix",
]
