"""Column expressions shared by the plans. All of them are built-in Spark functions."""

from postmill.functions.arrays import drop_blank, split_literal, tag_list
from postmill.functions.scalars import (
    author_status,
    blank_to_null,
    date_text,
    percent,
    ratio,
    score_band,
    timestamp_text,
    year_of,
)

__all__ = [
    "author_status",
    "blank_to_null",
    "date_text",
    "drop_blank",
    "percent",
    "ratio",
    "score_band",
    "split_literal",
    "tag_list",
    "timestamp_text",
    "year_of",
]
