"""Readers: XML dumps, catalog and path tables, lookup seeds."""

from postmill.sources.tables import lookup_table, post_types, read_seed, read_table
from postmill.sources.xml import (
    FILE,
    REASON,
    RAW,
    LAYOUTS,
    load_rows,
    parse_lines,
    split_rejects,
)

__all__ = [
    "FILE",
    "LAYOUTS",
    "RAW",
    "REASON",
    "load_rows",
    "lookup_table",
    "parse_lines",
    "post_types",
    "read_seed",
    "read_table",
    "split_rejects",
]
