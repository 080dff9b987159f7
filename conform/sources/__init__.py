"""Where tables come from and go to."""

from conform.sources.feeds import FeedSpec, ingest_all, ingest_feed, read_csv_feed
from conform.sources.tables import (
    qualified_name,
    read_table,
    set_current_catalog,
    write_table,
)
from conform.sources.versions import read_versions, write_versions

__all__ = [
    "FeedSpec",
    "ingest_all",
    "ingest_feed",
    "qualified_name",
    "read_csv_feed",
    "read_table",
    "read_versions",
    "set_current_catalog",
    "write_table",
    "write_versions",
]
