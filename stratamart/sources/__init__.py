"""Readers."""

from .feed import header_schema, malformed, read_feed, read_feed_audited, read_feed_inferred
from .star_feed import retail_feed
from .tables import read_evolving, read_run, table_exists

__all__ = [
    "header_schema",
    "malformed",
    "read_evolving",
    "read_feed",
    "read_feed_audited",
    "read_feed_inferred",
    "read_run",
    "retail_feed",
    "table_exists",
]
